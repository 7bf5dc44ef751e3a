"""Language identification: known words first, shorter n-grams for the rest.

A word that the training texts have scores by its log frequency in each
language. A word they do not have is cut into the longest character n-grams
(``MAX_GRAM`` characters, the word between blanks) of which any is known, and scores
their mean; if none is, the grams are a character shorter, down to single letters.
The scores of all words of a text are added; the largest sum wins.

1. *Sample.* The model is fitted on a bounded sample: of each language up to
   ``FIT_ROWS`` rows, those with the smallest hashed ``doc_id`` (rows over the expected
   limit leave at the scan), as far as ``FIT_BYTES`` of text go. Whole texts are learnt
   from. So the model's size is bounded for each language, whatever the corpus.
2. *Counts.* Tasks count words and n-grams, Spark adds the counts by
   ``(lang, gram)``; words seen once in a language are left to the n-grams.
3. *Scores.* The table of at most the sample's grams is broadcast to the tasks, which
   score every row where it is read: no shuffle of texts.

Words are runs of letters, lower-cased. Scores are log10 shares of a language's
words (or of its grams of that length), ``PENALTY`` where it has none. ``score`` is the
share of the chosen language in the sum of the likelihoods.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
so is any text if nothing could be learnt; ties go to the smaller language name; a
text of letters never learnt gets that name with an even score; rows with a null
``doc_id`` are scored, not learnt from; of repeated ids one text is learnt; a very
long text is read in parts that end at word ends; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import id_remainder, raw_texts
from tessera.session import drop_table, materialize, write_table

FIT_ROWS = 1500
FIT_BYTES = 16 << 20
MAX_GRAM = 5
MIN_COUNT = 2
PENALTY = 7.0
HELD_OUT, HELD_REMAINDER = 3, 1
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_PART = 1 << 20
_CACHE = 200_000


class Model(NamedTuple):
    """``rows``: log10 shares by language; ``words`` and ``grams``: their places."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray


def words(text: str) -> Counter:
    """The words of a text and how often each occurs."""
    found: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + _PART
        while end < len(text) and text[end].isalpha():
            end += 1
        found.update(_WORD.findall(text[start:end].lower()))
        start = end
    # \w knows a few numeric signs that are no letters
    for odd in [] if "".join(found).isalpha() else [w for w in found if not w.isalpha()]:
        times = found.pop(odd)
        for word in "".join(c if c.isalpha() else " " for c in odd).split():
            found[word] += times
    return found


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def sample(docs: DataFrame, training: Column, fit_rows: int = FIT_ROWS,
           fit_bytes: int = FIT_BYTES) -> DataFrame:
    """``lang, text`` of the rows that the model is fitted on."""
    known = docs.where(training & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = materialize(known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(29)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = (known.select("lang", "doc_id", "text").join(sizes, "lang")
             .where(u * F.col("rows") < F.lit(2 * fit_rows))
             .groupBy("lang", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
             .withColumn("u", u))
    order = Window.partitionBy("lang").orderBy("u", "doc_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (drawn.withColumn("place", F.row_number().over(order))
            .withColumn("size", F.sum(F.octet_length("text")).over(upto))
            .where((F.col("place") <= fit_rows) & (F.col("size") <= fit_bytes))
            .select("lang", "text"))


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, kind, gram, n``: the words (kind 0) and n-grams (kind n) of ``lang, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                seen.setdefault(lang, Counter()).update(words(raw.decode("utf-8", "replace")))
            for lang, found in seen.items():
                grams = [found, *(Counter() for _ in range(MAX_GRAM))]
                for word, times in found.items():
                    for n in range(1, MAX_GRAM + 1):
                        for gram in grams_of(word, n):
                            grams[n][gram] += times
                for kind, counts in enumerate(grams):
                    if counts:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(counts)), pa.array([kind] * len(counts), pa.int32()),
                             pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                            names=["lang", "kind", "gram", "n"])

    return (rows.mapInArrow(run, "lang string, kind int, gram string, n long")
            .groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, training: Column, fit_rows: int = FIT_ROWS,
          fit_bytes: int = FIT_BYTES) -> Model:
    """The model of the rows of ``docs`` where ``training`` holds."""
    counts, path = write_table(gram_counts(sample(docs, training, fit_rows, fit_bytes)), "grams")
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total")).collect()
    languages = sorted({r["lang"] for r in totals})
    place = {lang: i for i, lang in enumerate(languages)}
    total = {(r["lang"], r["kind"]): r["total"] for r in totals}
    kept = counts.where((F.col("kind") > 0) | (F.col("n") >= MIN_COUNT)).toArrow()   # within the sample
    drop_table(docs.sparkSession, path)
    known: tuple[dict[str, int], dict[str, int]] = ({}, {})
    cells = []
    for batch in kept.to_batches():
        for lang, kind, gram, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "kind", "gram", "n"))):
            at = known[kind > 0].setdefault(gram, len(known[0]) + len(known[1]))
            cells.append((at, place[lang], max(np.log10(n / total[lang, kind]), -PENALTY)))
    rows = np.full((len(known[0]) + len(known[1]), len(languages)), -PENALTY, dtype=np.float32)
    if cells:
        at, col, value = zip(*cells)
        rows[list(at), list(col)] = value
    return Model(languages, *known, rows)


class Scorer:
    """Scores texts by a model; the grams of unseen words are kept for a while."""

    def __init__(self, model: Model):
        self.model = model
        self.unseen: dict[str, list[int]] = {}

    def back_off(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of a word; none if not even a
        letter is known."""
        grams = self.model.grams
        for n in range(min(MAX_GRAM, len(word) + 2), 0, -1):
            found = [grams[g] for g in grams_of(word, n) if g in grams and not g.isspace()]
            if found:
                return found
        return []

    def text(self, text: str) -> tuple[str, float]:
        """``lang_pred, score`` of a text."""
        found = words(text)
        languages, known, unseen = self.model.languages, self.model.words, self.unseen
        if not found or not languages:
            return UNKNOWN, 0.0
        # the row and weight of each known word, and of each gram of the others
        rows, weights = [], []
        for word, n in found.items():
            at = known.get(word)
            if at is not None:
                rows.append(at)
                weights.append(n)
                continue
            grams = unseen.get(word)
            if grams is None:
                if len(unseen) >= _CACHE:
                    unseen.clear()
                grams = unseen[word] = self.back_off(word)
            if grams:
                rows += grams
                weights += [n / len(grams)] * len(grams)
        sums = np.array(weights, dtype=np.float64) @ self.model.rows[rows] if rows else np.zeros(len(languages))
        best = int(np.argmax(sums))
        return languages[best], float(1.0 / np.power(10.0, np.maximum(sums - sums[best], -300)).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``' rows as ``doc_id, lang_pred, score``."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*held.value))
        for batch in batches:
            out = [scorer.text(raw.decode("utf-8", "replace")) for raw in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, T.StructType([
        rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learnt from the rows
    that are not held out."""
    held_out = id_remainder(F.col("doc_id"), HELD_OUT) == HELD_REMAINDER
    return predict(docs, train(docs, ~held_out)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")
