"""Set-similarity jobs: token frequency, global token order, prefix index and
the exact Jaccard self-join with prefix, length and positional filtering.

Set records are ``rid LONG, tokens ARRAY<STRING>`` with one row per ``rid``
(:func:`token_frequency` also takes the long form ``rid, token``, one row per
occurrence, which needs no regrouping). Repeated tokens inside a record count
once everywhere except in :func:`token_frequency`, which counts occurrences.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import CEIL_EPS, check_threshold, prefix_length
from tessera.operators.grouping import SEGMENT_ITEMS, collect_segments
from tessera.session import drop_table, materialize, owned_tables, release_shuffles, shuffle_partitions, write_table

# Longs of the token bitmap of a small record (a power of two).
BITMAP_LONGS = 2
# Prefix tokens that a task of the self-join holds, about.
TASK_TOKENS = 2_000_000
# Records with a prefix token that meet in one place; more are dealt into blocks of so many.
BLOCK = 4096
# Pairs that a task of the self-join compares at a time, and the bitmap words of these.
PAIRS, WORDS = 1 << 18, 1 << 20
# Records whose tokens are sorted, dealt or packed at a time.
ROWS = 512
# Tokens of the records of a task that verifies pairs.
CELL_TOKENS = 6_000_000
# Most frequent tokens whose frequency orders them in the self-join.
HOT_TOKENS = 500_000


def token_frequency(sets: DataFrame) -> DataFrame:
    """Occurrences of every token (``token, freq``), ordered by frequency,
    then numerically where the token is a number, then as text."""
    tokens = (sets.select("token") if "token" in sets.columns
              else sets.select(F.explode("tokens").alias("token")))
    return (
        tokens
        .groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
        .orderBy(F.asc("freq"), F.col("token").try_cast("double").asc_nulls_last(),
                 F.asc("token"))
    )


def _one_per_rid(sets: DataFrame) -> DataFrame:
    """``rid, tokens``, checked: a ``rid`` that occurs twice fails the job (its
    records would be taken for one). The check is part of the expression that
    gives the tokens, so no plan can drop it; an aggregate keeps one record
    and a count per ``rid``, nothing more."""
    one = sets.groupBy("rid").agg(F.any_value("tokens").alias("tokens"), F.count(F.lit(1)).alias("times"))
    repeated = F.raise_error(F.concat(F.lit("repeated rid in set records: "), F.col("rid").cast("string")))
    return one.select("rid", F.when(F.col("times") > 1, repeated).otherwise(F.col("tokens")).alias("tokens"))


def _checked_rids(records: DataFrame) -> DataFrame:
    """Written ``records``, whose rids are checked as in :func:`_one_per_rid`, without
    shuffling anything else."""
    times = records.groupBy("rid").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    for r in times.limit(1).collect():
        raise ValueError(f"repeated rid in set records: {r.rid}")
    return records


def _distinct_tokens(sets: DataFrame) -> DataFrame:
    """``rid, toks, n``: the distinct tokens of each record and their number."""
    toks = F.array_distinct(F.col("tokens"))
    return _one_per_rid(sets).select(F.col("rid"), toks.alias("toks")).withColumn("n", F.size("toks"))


def _frequency_join(pairs: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``pairs`` with ``freq``, the number of rows that have its ``key``.

    Pairs and frequencies are written first: the pairs are made once, and
    both sides of the join are plain shuffles (or the small one a broadcast, by
    its file size), so adaptive execution splits the partition of a token that
    every record has."""
    pairs = materialize(pairs, "pairs")
    freq = materialize(pairs.where(F.col(key).isNotNull()).groupBy(key)
                       .agg(F.count(F.lit(1)).alias("freq")), "freq")
    return pairs.join(freq, key, how)


def _ranked_tokens(records: DataFrame) -> DataFrame:
    """``rid, n, token, freq, pos``: each distinct token of each record with its
    document frequency and 1-based position in the global order (frequency
    ascending, then token), which is the same for all records."""
    pairs = records.select("rid", "n", F.explode("toks").alias("token"))
    order = Window.partitionBy("rid").orderBy("freq", "token")
    return _frequency_join(pairs, "token").withColumn("pos", F.row_number().over(order))


def order_tokens(sets: DataFrame) -> DataFrame:
    """Each record's distinct tokens, rarest first (``rid, tokens``); ties in
    frequency by token text. Records without tokens keep an empty list.

    Also takes the long form ``rid, token`` (one row per occurrence): its
    distinct pairs come from a map-side partial distinct, with no regrouping
    into arrays first.
    """
    if "token" in sets.columns:
        pairs = sets.select("rid", "token").distinct()
    else:
        pairs = _distinct_tokens(sets).select("rid", F.explode_outer("toks").alias("token"))
    keyed = F.when(F.col("token").isNotNull(), F.struct("freq", "token"))
    return (
        _frequency_join(pairs, "token", "left")
        .groupBy("rid").agg(F.array_sort(F.collect_list(keyed)).alias("_s"))
        .select("rid", F.transform("_s", lambda x: x["token"]).alias("tokens"))
    )


def prefix_index(sets: DataFrame, t: float, segment_items: int = SEGMENT_ITEMS) -> DataFrame:
    """Inverted index of prefix tokens: ``token, segment, rids`` (sorted, at most
    ``segment_items`` a row; a token's next rids are in its next segment).

    A record of ``n`` distinct tokens contributes its first
    ``n - ceil(n*t) + 1`` tokens in the global order.
    """
    t = check_threshold(t)
    with owned_tables(sets.sparkSession) as keep:
        prefix = keep(_ranked_tokens(_distinct_tokens(sets)).where(
            F.col("pos") <= prefix_length(F.col("n"), t)).select("token", "rid"), "prefix")
    return collect_segments(prefix, "token", "rid", "rids", segment_items)


def similarity_candidates(sets: DataFrame, t: float) -> DataFrame:
    """Distinct ``rid_a < rid_b`` pairs that share a prefix token and pass the
    length and positional filters -- a superset of all pairs with Jaccard >= t."""
    return similarity_candidates_of(with_bitmap(_distinct_tokens(sets), _hashes()), check_threshold(t))


def _hashes() -> Column:
    """32-bit hashes of ``toks``."""
    return F.transform("toks", lambda x: F.shiftright(F.xxhash64(x), 32).cast("int"))


def _hot_tokens(records: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and frequencies of the most frequent tokens, all those of
    a frequency or none and at most :data:`HOT_TOKENS`, so the driver and the
    broadcast hold a bounded table however many tokens there are."""
    freq = materialize(records.select(F.explode(_hashes()).alias("th"))
                       .groupBy("th").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") > F.lit(1)), "freq")
    # half powers of two: few rows, however large the frequencies are
    step = F.floor(F.log2(F.col("freq").cast("double")) * F.lit(2.0))
    steps = sorted(((r.step, r.n) for r in freq.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()),
                   reverse=True)
    least, total = None, 0
    for at, n in steps:
        total += n
        if total > HOT_TOKENS:
            break
        least = at
    if least is None:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    hot = freq.where(step >= F.lit(least)).toArrow()
    th, n = (hot.column(c).to_numpy() for c in ("th", "freq"))
    order = np.argsort(th)
    return th[order], n[order]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of :data:`ROWS` records, so that what is made of their tokens at once is small."""
    for batch in batches:
        for s in range(0, batch.num_rows, ROWS):
            yield batch.slice(s, ROWS)


def _prefixes(hot, t: float):
    """From ``rid, n, bits..., h`` batches: ``rid, n, wide, th``, each record's parities
    (``bits`` if it has them) and prefix tokens in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, freq = hot.value
        for batch in _sliced(batches):
            lists, n = batch.column("h"), batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            th = lists.flatten().to_numpy(zero_copy_only=False)
            if not len(th):
                continue
            row = np.repeat(np.arange(len(n)), n)
            rank = np.zeros(len(th), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, th), len(known) - 1)
                rank = np.where(known[at] == th, freq[at], 0)
            th = th[np.lexsort((th, rank, row))]
            pos = np.arange(len(th)) - np.repeat(np.cumsum(n) - n, n) + 1
            length = n - np.ceil(n * t - CEIL_EPS).astype(np.int64) + 1
            bits = [batch.column(f"bits{j}") for j in range(BITMAP_LONGS)]
            small = np.flatnonzero(bits[0].is_valid().to_numpy(zero_copy_only=False))
            wide = np.empty(len(n), dtype=object)
            if len(small):
                words = np.stack([b.take(pa.array(small)).to_numpy(zero_copy_only=False) for b in bits], axis=1)
                raw, size = words.astype("<i8").tobytes(), 8 * BITMAP_LONGS
                wide[small] = [raw[i:i + size] for i in range(0, len(raw), size)]
            large = pa.array(np.flatnonzero(bits[0].is_null().to_numpy(zero_copy_only=False)))
            for got in _parities(iter([batch.select(["rid", "n", "h"]).take(large)])):
                wide[large.to_numpy()] = got.column("wide").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("n"), pa.array(wide.tolist(), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)),
                                          pa.array(th[pos <= length[row]]))],
                names=["rid", "n", "wide", "th"])

    return run


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes of 64-bit numbers."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _counted(tokens: np.ndarray):
    """From ``th`` batches: ``th, c``, how often each of the ``tokens`` (sorted) is in prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), dtype=np.int64)
        for batch in batches:
            th = batch.column("th").flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(tokens, th), len(tokens) - 1)
            total += np.bincount(at[tokens[at] == th], minlength=len(tokens))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tokens[some]), pa.array(total[some])], names=["th", "c"])

    return run


def _packets(tokens: np.ndarray, blocks: np.ndarray, parts: int):
    """From ``rid, n, wide, th`` batches: a row for each part that a record's prefix tokens
    are dealt to, ``part, rid, n, wide``, the tokens there (``th``) and four times
    their positions from 1, plus a side (``at``).

    The records of one of the ``tokens`` (sorted) are dealt into ``blocks``, and every
    two blocks, or one with itself, are a token of their own: a record is in as
    many as there are blocks, on side 1 or 2 of two blocks. On side 0 all meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            lists = batch.column("th")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            th = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            begin = np.cumsum(size) - size
            row = np.repeat(np.arange(len(size)), size)
            at = 4 * (np.arange(len(th)) - begin[row] + 1)
            if len(tokens):
                found = np.minimum(np.searchsorted(tokens, th), len(tokens) - 1)
                hot = np.flatnonzero(tokens[found] == th)
                many = blocks[found[hot]]
                record = _mixed(np.add.reduceat(th.astype(np.int64), begin))[row[hot]]
                own = np.repeat((record % many.astype(np.uint64)).astype(np.int64), many)
                other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                low, high = np.minimum(own, other), np.maximum(own, other)
                side = np.where(low == high, 0, np.where(own == low, 1, 2))
                again = np.repeat(hot, many)
                cell = _mixed(_mixed(th[again].astype(np.int64)) ^ (low << 32 | high).astype(np.uint64))
                cold = np.ones(len(th), dtype=bool)
                cold[hot] = False
                row = np.concatenate([row[cold], row[again]])
                th = np.concatenate([th[cold], cell.astype(np.uint32).view(np.int32)])
                at = np.concatenate([at[cold], at[again] + side])
            part = (_mixed(th.view(np.uint32)) % np.uint64(parts)).astype(np.int32)
            order = np.lexsort((part, row))
            row, part = row[order], part[order]
            cuts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])]))
            ends, record = pa.array(np.append(cuts, len(row)).astype(np.int32)), pa.array(row[cuts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts]), *(batch.column(c).take(record) for c in ("rid", "n", "wide")),
                 pa.ListArray.from_arrays(ends, pa.array(th[order])),
                 pa.ListArray.from_arrays(ends, pa.array(at[order].astype(np.int32)))],
                names=["part", "rid", "n", "wide", "th", "at"])

    return run


class _Parities:
    """Parity bitmaps of records, each also folded to all smaller sizes that a bitmap here has."""

    def __init__(self, wide: pa.Array):
        data = np.frombuffer(wide.buffers()[2], np.uint8)
        ends = np.frombuffer(wide.buffers()[1], np.int32)[wide.offset:wide.offset + len(wide) + 1].astype(np.int64)
        self.words = np.diff(ends) // 8
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows, bits = np.empty(0, np.int64), np.empty((0, 0), np.uint64)
        for w in sorted(set(self.words.tolist()), reverse=True):
            while len(rows) and bits.shape[1] > w:
                bits = bits[:, :bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2:]
            own = np.flatnonzero(self.words == w)
            mine = data[ends[own][:, None] + np.arange(8 * w)].view(np.uint64)
            rows, bits = np.concatenate([rows, own]), np.concatenate([bits.reshape(len(rows), w), mine])
            place = np.full(len(self.words), -1, dtype=np.int32)
            place[rows] = np.arange(len(rows))
            self.levels[w] = place, bits

    def differences(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:func:`parity_differences` of rows ``a`` and ``b``."""
        out, words = np.zeros(len(a), dtype=np.int64), np.minimum(self.words[a], self.words[b])
        for w, (place, bits) in self.levels.items():
            mine = np.flatnonzero(words == w)
            for s in range(0, len(mine), max(1, WORDS // w)):
                i = mine[s:s + max(1, WORDS // w)]
                out[i] = np.bitwise_count(bits[place[a[i]]] ^ bits[place[b[i]]]).sum(axis=1, dtype=np.int64)
        return out


def _joined(t: float):
    """From the rows of :func:`_packets` of one part: the pairs ``x, y`` of records that share a
    token there and pass the length, positional and bitmap filters, once each."""
    share = t / (1.0 + t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rid, n, wide, th, at = (pa.concat_arrays([b.column(c) for b in parts]) for c in ("rid", "n", "wide", "th", "at"))
        parities, total = _Parities(wide.cast(pa.binary())), len(rid)
        del parts, wide
        pa.default_memory_pool().release_unused()
        row = np.repeat(np.arange(total, dtype=np.int32), th.value_lengths().to_numpy(zero_copy_only=False))
        th, at, n = (x.to_numpy(zero_copy_only=False) for x in (th.flatten(), at.flatten(), n))
        order = np.lexsort((n[row], th)).astype(np.int32)
        row, th, at = row[order], th[order], at[order]
        size, side = n[row], (at & 3).astype(np.int8)
        rest = size - (at >> 2)                  # tokens behind the shared one
        del order, at
        # partners are the records behind of the same token, as large or larger, up to the sizes
        # that the length filter and the position of the shared token here allow
        most, place = int(size.max()), np.cumsum(np.concatenate([[0], th[1:] != th[:-1]]))
        place *= most + 2
        place += size
        del th
        many = np.empty(len(row), dtype=np.int32)
        for s in range(0, len(row), PAIRS):
            m, left = size[s:s + PAIRS], rest[s:s + PAIRS]
            largest = np.minimum(np.floor((m + CEIL_EPS) / t + 1e-6), np.floor((left + 1 + CEIL_EPS) / share + 1e-6) - m)
            last = place[s:s + PAIRS] - m + np.clip(largest, 0, most).astype(np.int64)
            many[s:s + PAIRS] = np.maximum(np.searchsorted(place, last, side="right") - np.arange(s + 1, s + 1 + len(m)), 0)
        del place
        ends = np.cumsum(many, dtype=np.int64)
        found, held = [], 0

        def pairs() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([rid.take(pa.array(x)) for x in np.divmod(found[0], total)], names=["x", "y"])

        s = 0
        while s < len(row):
            done = ends[s - 1] if s else 0
            e = max(s + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
            count = many[s:e]
            i = np.repeat(np.arange(s, e), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(ends[s:e] - count - done, count)
            s = e
            need = (size[i] + size[j]) * share - CEIL_EPS
            ok = np.flatnonzero((np.minimum(rest[i], rest[j]) + 1 >= need) & (row[i] != row[j])
                                & ((side[i] != side[j]) | (side[i] == 0)))
            i, j, need = row[i[ok]].astype(np.int64), row[j[ok]].astype(np.int64), need[ok]
            close = parities.differences(i, j) <= n[i] + n[j] - 2 * need
            i, j = i[close], j[close]
            found.append(np.unique(np.minimum(i, j) * total + np.maximum(i, j)))
            held += len(found[-1])
            if held > 8 * PAIRS or s == len(row):
                found = [np.unique(np.concatenate(found))]
                held = len(found[0])
                if held > 4 * PAIRS or s == len(row):
                    yield pairs()
                    found, held = [], 0

    return run


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``rid, n, h`` batches: ``rid, n, wide``, the parities of a record's tokens in
    2 to 4 times ``n`` bits (a power of two)."""
    for batch in batches:
        lists = batch.column("h")
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        wide = []
        for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
            m = max(64, 1 << (2 * (e - s) - 1).bit_length())
            wide.append(np.packbits(np.bincount(flat[s:e] & (m - 1), minlength=m) & 1, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("n"), pa.array(wide, pa.binary())],
                                         names=["rid", "n", "wide"])


def parity_differences(a: bytes, b: bytes) -> int:
    """Differing bits of two parity bitmaps, the longer one folded: at most as
    many as there are tokens that one record has and the other has not."""
    if len(a) < len(b):
        a, b = b, a
    x, size = int.from_bytes(a, "little"), 8 * len(a)
    while size > 8 * len(b):
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def with_bitmap(records: DataFrame, hashes: Column) -> DataFrame:
    """``records`` plus ``bits``, :data:`BITMAP_LONGS` longs: each bit is the parity
    of the tokens hashed to it. Null for a record with under two bits a token."""
    def word(j: int) -> Column:
        bit = F.expr(f"aggregate(_h, 0L, (acc, x) -> acc ^ if((x >> 6) & {BITMAP_LONGS - 1} = {j}, "
                     "shiftleft(1L, cast(x & 63 as int)), 0L))")
        return F.when(F.size("_h") <= F.lit(32 * BITMAP_LONGS), bit).alias(f"bits{j}")

    return records.withColumn("_h", hashes).select(*records.columns, *(word(j) for j in range(BITMAP_LONGS)))


def similarity_candidates_of(records: DataFrame, t: float, copies: DataFrame | None = None) -> DataFrame:
    """:func:`similarity_candidates` over (written) ``rid, toks, n`` records with the
    bitmaps of :func:`with_bitmap` without those whose ``rid`` is in ``copies``; written, too.

    Prefix filter: let a pair need an overlap of alpha (alpha >= t*n for both
    records when their sizes pass the length filter). Its first shared token in the global order
    lies within the first ``n - alpha + 1`` tokens of each record, so with
    prefixes of ``n - ceil(t*n) + 1`` tokens a similar pair shares one that
    passes the positional filter: ``1 + min(n_a - pos_a, n_b - pos_b) >= alpha``.

    Any order of the tokens that is the same for all records is lossless. Ours
    is by the frequency of the most frequent ones (:func:`_hot_tokens`; the
    others are 0), then by 32-bit hash, so a record's prefix is found in its own
    row: no token row is shuffled before the join. Frequencies and join are by
    hash: tokens that clash have one place in the order, so a clash adds a shared
    token, and what follows it in both records still bounds the rest.

    Bitmap filter: two records differ in at least as many tokens as their
    parities (two bits a token or more) in bits, so a pair whose parities differ in more
    than ``na + nb - 2 * alpha`` bits leaves in the join, whatever tokens it shares;
    no similar pair does.

    The join deals tokens to parts, and a record's row with its parities to each
    part that has a token of its prefix (:func:`_packets`), so a row carries the
    parities once for all its tokens there and what leaves a task (:func:`_joined`) is a pair that
    passed all filters, not one row for every token it shares. A task holds about :data:`TASK_TOKENS` tokens
    and compares :data:`PAIRS` pairs at a time; the records of a token that more than :data:`BLOCK`
    prefixes have meet in blocks of so many, in different tasks.
    """
    spark = records.sparkSession
    began = time.monotonic()
    hot = spark.sparkContext.broadcast(_hot_tokens(records))
    ids = records.schema["rid"].dataType.simpleString()
    bits = (F.when(F.col("n") <= F.lit(32 * BITMAP_LONGS), F.col(f"bits{j}")).alias(f"bits{j}") for j in range(BITMAP_LONGS))
    rows = (records.where(F.col("rid").isNotNull() & (F.col("n") > F.lit(0))).select("rid", "n", *bits, _hashes().alias("h"))
            .mapInArrow(_prefixes(hot, t), f"rid {ids}, n int, wide binary, th array<int>"))
    # shuffled for this, if at all, without the tokens that are in no prefix
    prefix, path = write_table(rows.join(copies, "rid", "left_anti") if copies is not None else rows, "prefix")
    release_shuffles(spark, began)
    total = prefix.agg(F.sum(F.size("th"))).first()[0] or 0
    known, freq = hot.value
    known = known[freq > BLOCK]
    many = (prefix.select("th").mapInArrow(_counted(known), "th int, c long").groupBy("th").agg(F.sum("c").alias("c"))
            .where(F.col("c") > F.lit(BLOCK)).orderBy("th").collect()) if len(known) else []
    tokens, blocks = np.array([r.th for r in many], np.int32), np.array([-(-r.c // BLOCK) for r in many], np.int64)
    parts = max(-(-(total + int(BLOCK * (blocks * blocks).sum())) // TASK_TOKENS), min(12, shuffle_partitions(spark)))
    joined = (
        prefix.mapInArrow(_packets(tokens, blocks, parts), f"part int, rid {ids}, n int, wide binary, th array<int>, at array<int>")
        .repartitionById(parts, F.col("part")).drop("part")
        .mapInArrow(_joined(t), f"x {ids}, y {ids}"))
    found = materialize(joined.select(F.least("x", "y").alias("rid_a"), F.greatest("x", "y").alias("rid_b")).distinct(), "candidates")
    drop_table(spark, path)
    release_shuffles(spark, began)
    return found


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``rid, toks`` batches: ``rid, packed``, the lengths (-1: null) and bytes of the tokens, compressed."""
    for batch in _sliced(batches):
        lists = batch.column("toks")
        toks = lists.flatten().cast(pa.binary())
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64).tolist()
        at = np.frombuffer(toks.buffers()[1], np.int32)[toks.offset:toks.offset + len(toks) + 1]
        size = np.where(toks.is_valid().to_numpy(zero_copy_only=False), np.diff(at), -1).astype(np.int32)
        data, at = memoryview(toks.buffers()[2] or b""), at.tolist()
        out = []
        for s, e in zip(ends[:-1], ends[1:]):
            out.append(zlib.compress((e - s).to_bytes(4, "little") + size[s:e].tobytes() + data[at[s]:at[e]], 1))
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(out, pa.binary())], names=["rid", "packed"])


def _packed_tokens(records: DataFrame) -> DataFrame:
    """``rid, packed`` of :func:`_packed`: equal for equal token lists, for shuffles a third of their size."""
    ids = records.schema["rid"].dataType.simpleString()
    return records.select("rid", "toks").mapInArrow(_packed, f"rid {ids}, packed binary")


def _token_codes(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Of the records of :func:`_packed`: the tokens as numbers, equal for equal tokens, the end
    of each record's (from 0), and a bound of the numbers."""
    raw = [zlib.decompress(x) for x in packed]
    n = [int.from_bytes(x[:4], "little") for x in raw]
    size = np.concatenate([np.frombuffer(x, np.int32, m, 4) for x, m in zip(raw, n)])
    data = b"".join(memoryview(x)[4 + 4 * m:] for x, m in zip(raw, n))
    del raw
    at = np.concatenate([[0], np.cumsum(np.maximum(size, 0), dtype=np.int64)])
    toks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(data)])
    codes = toks.dictionary_encode()
    return (np.where(size < 0, len(codes.dictionary), codes.indices.to_numpy()),
            np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), len(codes.dictionary) + 1)


def _verified(t: float):
    """From the ``rid_a, packed`` rows of records and the ``rid_a, rid_b`` rows of pairs of these:
    ``rid_a, rid_b, sim`` of the pairs with Jaccard >= t."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        records = pa.Table.from_batches([b.filter(b.column("packed").is_valid()) for b in rows]) if rows else None
        if not records:
            return
        pairs = pa.Table.from_batches([b.filter(b.column("packed").is_null()) for b in rows])
        del rows
        rids = records.column("rid_a").combine_chunks()
        codes, ends, bound = _token_codes(records.column("packed").to_pylist())
        del records
        a, b = (pc.index_in(pairs.column(c), value_set=rids).to_numpy().astype(np.int64) for c in ("rid_a", "rid_b"))
        order = np.argsort(a, kind="stable")
        size, same, mark = np.diff(ends), np.zeros(len(a), dtype=np.int64), np.zeros(bound, dtype=bool)
        cuts = np.flatnonzero(np.diff(a[order], prepend=-1, append=-1)).tolist()
        for s, e in zip(cuts[:-1], cuts[1:]):
            mine = codes[ends[a[order[s]]]:ends[a[order[s]] + 1]]
            mark[mine] = True
            others = b[order[s:e]]
            total = np.cumsum(size[others])
            while len(others):           # about PAIRS tokens at a time
                m = max(1, int(np.searchsorted(total, PAIRS, side="right")))
                n, begin = size[others[:m]], total[:m] - size[others[:m]]
                at = np.arange(total[m - 1]) + np.repeat(ends[others[:m]] - begin, n)
                same[order[s:s + m]] = np.add.reduceat(mark[codes[at]], begin, dtype=np.int64)
                s, others, total = s + m, others[m:], total[m:] - total[m - 1]
            mark[mine] = False
        sim = same / (size[a] + size[b] - same)
        keep = np.flatnonzero(sim >= t)
        yield from pairs.select(["rid_a", "rid_b"]).append_column("sim", pa.array(sim)).take(pa.array(keep)).combine_chunks().to_batches()

    return run


def _verify(records: DataFrame, pairs: DataFrame, t: float) -> DataFrame:
    """``rid_a, rid_b, sim`` of the (written) ``pairs`` of (written) ``rid, toks, n`` records with
    Jaccard >= t, by their token strings.

    Records are dealt into blocks by ``rid`` so that two blocks have about :data:`CELL_TOKENS`
    tokens. A task has the pairs of two blocks (or of one with itself) and the records of these
    pairs, so a record goes once to each task that needs it and to at most as many
    tasks as there are blocks, however many pairs it is in."""
    spark = records.sparkSession
    ids = records.schema["rid"].dataType.simpleString()
    ends = pairs.select(F.explode(F.array("rid_a", "rid_b")).alias("rid")).distinct()
    tokens = records.select("rid", "n").join(ends, "rid", "left_semi").agg(F.sum("n")).first()[0] or 0
    blocks = max(-(-2 * tokens // CELL_TOKENS), 3)
    i, j = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("rid_a", "rid_b"))
    low, high = F.least(i, j), F.greatest(i, j)
    placed = pairs.withColumn("cell", (F.shiftright(high * (high + F.lit(1)), 1) + low).cast("int"))
    cells = (placed.select("cell", F.explode(F.array("rid_a", "rid_b")).alias("rid")).distinct()
             .groupBy("rid").agg(F.collect_list("cell").alias("cells")))
    packed = (_packed_tokens(records).join(cells, "rid")
              .select(F.explode("cells").alias("cell"), F.col("rid").alias("rid_a"), F.lit(None).cast(ids).alias("rid_b"), "packed"))
    rows = packed.unionByName(placed.withColumn("packed", F.lit(None).cast("binary")))
    return (rows.repartitionById(blocks * (blocks + 1) // 2, F.col("cell")).drop("cell")
            .mapInArrow(_verified(t), f"rid_a {ids}, rid_b {ids}, sim double"))


def _exact_copies(records: DataFrame) -> DataFrame:
    """``rid, rep``: records whose token set is identical to that of a
    representative ``rep`` (the smallest rid of its group), ``rid != rep``.

    Groups are formed on (64-bit signature of the sorted token set, size),
    moving only ``(rid, sig, n)``. Each member is then confirmed by comparing
    its (packed) tokens with its representative's, so a signature clash merely
    leaves a record unmerged.
    """
    sigs = records.select("rid", "sig", "n")
    groups = (sigs.groupBy("sig", "n")
              .agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("m"))
              .where(F.col("m") > F.lit(1)))
    member = materialize(sigs.join(groups, ["sig", "n"]).where(F.col("rid") != F.col("rep"))
                         .select("rid", "rep"), "member")
    ends = member.select(F.explode(F.array("rid", "rep")).alias("rid")).distinct()
    toks = _packed_tokens(records).join(ends, "rid", "left_semi")
    tx = toks.select("rid", F.col("packed").alias("tx"))
    tr = toks.select(F.col("rid").alias("rep"), F.col("packed").alias("tr"))
    return materialize(member.join(tx, "rid").join(tr, "rep")
                       .where(F.col("tx") == F.col("tr")).select("rid", "rep"))


def _expand_copies(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs between representatives -> pairs between all their copies, plus
    the pairs inside each group of copies (Jaccard 1.0). Every row produced
    is part of the answer; a large group's rows are spread by AQE's skew
    handling of the joins on ``rep``."""
    reps = copies.select("rep").distinct()
    members = copies.select("rep", F.col("rid").alias("member")).unionByName(
        reps.select("rep", F.col("rep").alias("member")))
    ma = members.select(F.col("rep").alias("rid_a"), F.col("member").alias("xa"))
    mb = members.select(F.col("rep").alias("rid_b"), F.col("member").alias("xb"))
    spread = (pairs.join(ma, "rid_a", "left").join(mb, "rid_b", "left")
              .select(F.coalesce("xa", "rid_a").alias("xa"),
                      F.coalesce("xb", "rid_b").alias("xb"), "sim"))
    across = spread.select(F.least("xa", "xb").alias("rid_a"),
                           F.greatest("xa", "xb").alias("rid_b"), "sim")
    x, y = members.alias("x"), members.alias("y")
    within = x.join(y, (F.col("x.rep") == F.col("y.rep"))
                    & (F.col("x.member") < F.col("y.member"))).select(
        F.col("x.member").alias("rid_a"), F.col("y.member").alias("rid_b"),
        F.lit(1.0).alias("sim"))
    return across.unionByName(within)


def _class_pairs(sets: DataFrame, t: float) -> tuple[DataFrame, DataFrame]:
    """``rid_a, rid_b, sim`` pairs between different token sets, each named by
    its smallest rid, and the ``rid, rep`` of the others that have the same set.

    1. The records (sorted distinct tokens, their number, a signature of the
       set and its bitmap) are computed and written once. Token lists move only
       packed, each for the copies and for the pairs that it is in; a record with very many candidates
       meets them in the tasks of its block with all others.
    2. Exact copies are collapsed to one representative
       (:func:`_exact_copies`), so a large group of copies costs no quadratic
       blow-up per prefix token.
    3. Candidates among the remaining records from the prefix, length,
       positional and bitmap filters (:func:`similarity_candidates`), the last by the parities of
       the tokens in 2 to 4 bits a token (:func:`_parities`).
    4. Exact: the candidates are verified on the token strings (:func:`_verify`).
    """
    t = check_threshold(t)
    toks = F.array_sort(F.array_distinct(F.col("tokens")))
    records = _checked_rids(materialize(
        with_bitmap(sets.select("rid", F.coalesce(toks, F.array().cast("array<string>")).alias("toks"))
                    .select("rid", "toks", F.size("toks").alias("n"), F.xxhash64("toks").alias("sig")), _hashes()),
        "records")).where(F.col("n") > F.lit(0))
    copies = _exact_copies(records)
    return _verify(records, similarity_candidates_of(records, t, copies), t), copies


def set_similarity_join(sets: DataFrame, t: float, ordered: bool = True) -> DataFrame:
    """All record pairs with Jaccard similarity >= t: ``rid_a, rid_b, sim``
    with ``rid_a < rid_b``, ordered by ``rid_a, rid_b`` unless ``ordered`` is
    false. Records without tokens pair with nothing.

    The pairs between different sets (:func:`_class_pairs`) are expanded to all
    their copies (:func:`_expand_copies`).

    The result is written before the job's other tables are deleted, so the
    returned DataFrame reads only its own files.
    """
    with owned_tables(sets.sparkSession) as keep:
        out = keep(_expand_copies(*_class_pairs(sets, t)), "pairs-out")
    return out.orderBy("rid_a", "rid_b") if ordered else out


def set_similarity_classes(sets: DataFrame, t: float) -> DataFrame:
    """:func:`set_similarity_join` without the pairs that copies repeat: a class of records with the same token set is named by its smallest rid.
    ``rid_a, rid_b, sim`` with ``sim`` < 1 is a pair of classes, with ``sim`` = 1 (which
    different sets never have) the membership of ``rid_b`` in the class ``rid_a``. Every
    pair of the join is the pair of its records' classes, or one class."""
    with owned_tables(sets.sparkSession) as keep:
        pairs, copies = _class_pairs(sets, t)
        out = keep(pairs.unionByName(copies.select(
            F.col("rep").alias("rid_a"), F.col("rid").alias("rid_b"), F.lit(1.0).alias("sim"))), "pairs-out")
    return out.orderBy("rid_a", "rid_b")
