"""Column expressions for Jaccard set similarity and prefix filtering."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tolerance for ceil(n*t): n*t in floating point can land just above an
# integer (25 * 0.28 = 7.000000000000001) and would shorten the prefix.
CEIL_EPS = 1e-9


def check_threshold(t: float) -> float:
    t = float(t)
    if not 0.0 < t <= 1.0:
        raise ValueError(f"similarity threshold must be in (0, 1], got {t}")
    return t


def prefix_length(n: Column, t: float) -> Column:
    """Tokens of a size-``n`` set that must be indexed so that any partner with
    Jaccard >= t shares at least one of them: ``n - ceil(n*t) + 1``."""
    return (n - F.ceil(n * F.lit(t) - F.lit(CEIL_EPS)) + F.lit(1)).cast("int")


def length_compatible(n_a: Column, n_b: Column, t: float) -> Column:
    """Length filter: Jaccard(a, b) <= min/max size, so both sizes must be
    within a factor t of each other (lossless)."""
    lo = F.least(n_a, n_b)
    hi = F.greatest(n_a, n_b)
    return lo >= hi * F.lit(t) - F.lit(CEIL_EPS)


def overlap_needed(n_a: Column, n_b: Column, t: float) -> Column:
    """Real-valued overlap a pair needs for Jaccard >= t: ``t/(1+t)*(n_a+n_b)``
    (minus a tolerance, so comparisons err on the side of keeping a pair)."""
    return (n_a + n_b) * F.lit(t / (1.0 + t)) - F.lit(CEIL_EPS)


def position_compatible(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column,
                        t: float, k: int = 1) -> Column:
    """Positional filter at a shared token (1-based positions in the global
    token order). Let the pair need an overlap of alpha. The j-th shared token
    (in the global order) sits at most at position ``n - alpha + j`` in each
    record, so for j <= k it satisfies ``k + min(n_a - pos_a, n_b - pos_b)
    >= alpha``. Rows failing this cannot be among a similar pair's first k
    shared tokens; keeping the rest is lossless."""
    bound = F.lit(k) + F.least(n_a - pos_a, n_b - pos_b)
    return bound >= overlap_needed(n_a, n_b, t)


def jaccard(inter: Column, n_a: Column, n_b: Column) -> Column:
    """|a & b| / |a | b| as a double, from the intersection and the sizes."""
    return inter.cast("double") / (n_a + n_b - inter).cast("double")


def size_band(n: Column, t: float) -> Column:
    """Band of a set size such that two sizes passing :func:`length_compatible`
    always fall in the same or adjacent bands.

    Bands are ``floor(ln(n) / w)`` with width ``w = ln(1/t)`` widened by a
    relative 1e-9, which keeps floating-point rounding at a band edge from
    separating a compatible pair by two bands. For t = 1 sizes must be equal
    and the band is the size itself.
    """
    if t >= 1.0:
        return n.cast("long")
    width = -math.log(t) * (1.0 + 1e-9)
    return F.floor(F.log(n.cast("double")) / F.lit(width)).cast("long")
