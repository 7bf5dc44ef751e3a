"""Benchmark decontamination: containment search for short test items in long
documents, by size-partitioned MinHash sketches and an exact check.

Words are the lower-cased runs of letters and digits, shingles ``SHINGLE``
consecutive words (an item of fewer words is one shingle of its own length). A
document is contaminated by an item if it holds at least ``THRESHOLD`` of the
item's distinct shingles.

Items are partitioned by size, a class for each doubling of their number of
shingles. An item's sketch is its k smallest shingle hashes (bottom-k MinHash),
k depending on the class: with at most u shingles in the class,
``k = u - ceil(t * u) + 1``. A document that lacks all k of n <= u shingles
holds fewer than ``t * n`` of them, so probing the sketches with every shingle
of a document misses nothing, however long the document is. (A sketch of the
document itself would: at 30 shingles in 20,000 the two sketches hardly meet.)
Candidates are then compared shingle by shingle, as text.

Only built-in functions are used. The texts are exploded and filtered where
they are read; the sketch table is written first, so that it is broadcast only
if its files are small, and joined by a shuffle otherwise. Documents are
identified by a digest of their text: copies are verified once, whatever their
number.

Defined results: a null or empty text or item matches nothing; repeated items
and documents each give their rows; null ids stay null; an empty table gives
an empty result; other columns are ignored or, by
:func:`drop_contaminated`, returned as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
_CEIL_EPS = 1e-9


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _starts(width: int) -> Column:
    """0-based starts of the shingles of ``width`` words; none if too short."""
    n = F.size("w")
    return F.when(n >= width, F.sequence(F.lit(0), n - F.lit(width)))


def _shingle_hashes(width: int) -> Column:
    """Hashes of the shingles of ``width`` words of the column ``w``."""
    return F.transform(_starts(width), lambda i: F.xxhash64(
        *(F.col("w")[i + F.lit(k)] for k in range(width))))


def _shingle_texts(width: int) -> Column:
    return F.array_distinct(F.transform(_starts(width), lambda i: F.concat_ws(
        " ", *(F.col("w")[i + F.lit(k)] for k in range(width)))))


def _by_width(df: DataFrame, make, shingle: int) -> Column:
    """``make(width)`` for the row's own ``width`` (1 to ``shingle``)."""
    out = make(shingle)
    for width in range(1, shingle):
        out = F.when(F.col("width") == width, make(width)).otherwise(out)
    return out


def item_shingles(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``item, width, n, texts, hashes``: one row per distinct item text with
    words; ``item`` is the digest of the text."""
    w = items.select(F.md5("text").alias("item"), words(F.col("text")).alias("w"))
    w = (w.where(F.size("w") > 0).dropDuplicates(["item"])
         .withColumn("width", F.least(F.size("w"), F.lit(shingle))))
    out = w.select("item", "width", _by_width(w, _shingle_texts, shingle).alias("texts"),
                   F.array_distinct(_by_width(w, _shingle_hashes, shingle)).alias("hashes"))
    return out.withColumn("n", F.size("texts"))


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """``h, width, item, n``: the bottom-k hashes of every item."""
    size_class = F.floor(F.log2(F.col("n").cast("double")))
    u = F.max("n").over(Window.partitionBy("width", size_class))
    k = u - F.ceil(u * F.lit(threshold) - F.lit(_CEIL_EPS)) + F.lit(1)
    return (shingles.withColumn("k", k.cast("int"))
            .select("width", "item", "n", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.col("k"))).alias("h")))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc, item, n_shingles, n_matched, containment``: every pair of a
    distinct document text and a distinct item text (by digest) with a
    containment of at least ``threshold``."""
    shingles = materialize(item_shingles(items, shingle), "items")
    sketch = materialize(sketches(shingles, threshold), "sketches")
    texts = docs.select(F.md5("text").alias("doc"), words(F.col("text")).alias("w"))
    found = None
    # at most `shingle` widths; one scan of the documents for each that occurs
    for (width,) in shingles.select("width").distinct().collect():
        probes = texts.where(F.size("w") >= width).select(
            "doc", F.size("w").alias("n_words"), F.explode(_shingle_hashes(width)).alias("h"))
        hits = probes.join(sketch.where(F.col("width") == width), "h")
        need = F.ceil(F.col("n") * F.lit(threshold) - F.lit(_CEIL_EPS))
        hits = hits.where(F.col("n_words") - F.lit(width - 1) >= need).select("doc", "item")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = texts.select("doc", F.col("doc").alias("item")).limit(0)
    pairs = materialize(found.distinct(), "candidates")
    suspects = materialize(pairs.select("doc").distinct(), "suspects")
    held = (docs.select(F.md5("text").alias("doc"), "text").join(suspects, "doc", "left_semi")
            .dropDuplicates(["doc"]).select("doc", words(F.col("text")).alias("w")))
    # per candidate document: its pairs, the items' shingles, the exact overlap
    compared = pairs.join(held, "doc").join(shingles.drop("hashes"), "item")
    overlap = F.size(F.array_intersect("texts", _by_width(compared, _shingle_texts, shingle)))
    compared = compared.select("doc", "item", F.col("n").cast("long").alias("n_shingles"),
                               overlap.cast("long").alias("n_matched"))
    return (compared.withColumn("containment", F.col("n_matched") / F.col("n_shingles"))
            .where(F.col("containment") >= F.lit(threshold)))


def contamination_report(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                         shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_matched, containment`` of every
    contaminated row of ``docs`` and item it holds."""
    pairs = materialize(contaminated(docs, items, threshold, shingle), "pairs")
    names = items.select("item_id", F.md5("text").alias("item"))
    hits = materialize(pairs.join(names, "item").drop("item"), "hits")
    return docs.select("doc_id", F.md5("text").alias("doc")).join(hits, "doc").select(
        "doc_id", "item_id", "n_shingles", "n_matched", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    bad = contaminated(docs, items, threshold, shingle)
    bad = materialize(bad.select(F.col("doc").alias("__bad_doc")).distinct(), "contaminated")
    return (docs.withColumn("__doc", F.md5("text"))
            .join(bad, F.col("__doc") == F.col("__bad_doc"), "left_anti").select(*docs.columns))
