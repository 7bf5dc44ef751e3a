"""Quality classifier: naive Bayes support vectors.

A text's n-gram indicators (words, word pairs, byte 3-grams, 4-grams of the
text's shape, and a few buckets of its length and repetition) are hashed to
``2**BITS`` features. Each is scaled by its log-count ratio between the classes,
``log((p + 1) / |p|) - log((q + 1) / |q|)`` with p and q the numbers of documents
of either class that have it, each text is scaled to length 1, and a linear
hinge-loss model is fitted by dual coordinate descent. Margins are turned into
probabilities by a logistic fit on margins of documents left out of a first fit.

The counts cover all labelled training rows: every task sums its own, and one
aggregate adds them up. Only the descent runs on a bounded sample, of each class
the ``FIT_ROWS`` / 2 training rows of smallest id hash, more if the other class has
fewer (its features, about 5 kB a row, go to the driver); the scores are
corrected for the shares that the classes have among all training rows. The model is 2**BITS weights. Scoring reads every text
where it lies.

Defined results: a null text is empty; an empty text has the score of the
bucket features alone; labels that are null, or of unknown ids, are ignored, of
an id's several labels the largest counts; with no labels of one class every
score is the share of label 1 (0.5 without labels); null ids and repeated rows
are scored like any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import append_columns, id_remainder, raw_texts
from tessera.session import write_table, drop_table

BITS = 18
FIT_ROWS = 4000           # bound of the sample that the descent sees
EPOCHS = 12
COST = 1.0
HELD_OUT = 5              # ids with crc32 mod 5 = 0 are never learnt from
THRESHOLD = 0.3
SEED = 11

_SHAPE = bytes(ord("X") if 65 <= i <= 90 else ord("x") if 97 <= i <= 122 or i > 127
               else ord("9") if 48 <= i <= 57 else i for i in range(256))
_M = np.uint64(0x9E3779B97F4A7C15)


def _slots(codes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """Feature numbers of integer codes; each kind of n-gram is mixed apart."""
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64) + np.uint64(kind) * np.uint64(0xD1B54A32D192ED03)) * _M
        return ((x ^ (x >> np.uint64(29))) * _M >> np.uint64(64 - bits)).astype(np.int32)


def _distinct(slots: np.ndarray) -> np.ndarray:
    slots = np.sort(slots)
    return slots[np.concatenate([[True], slots[1:] != slots[:-1]])] if len(slots) else slots


def indicators(raw: bytes, bits: int = BITS) -> np.ndarray:
    """Distinct feature numbers of a text."""
    words = raw.split()
    n = len(words)
    parts = [_slots(np.array([min(n.bit_length(), 16)]), 1, bits)]
    if n:
        h = np.fromiter(map(crc32, words), dtype=np.uint64, count=n)
        parts.append(_slots(h, 2, bits))
        if n > 1:
            with np.errstate(over="ignore"):
                pairs = _distinct(_slots(h[:-1] * _M + h[1:], 3, bits))
            same = int((h[1:] == h[:-1]).sum())
            parts += [pairs, _slots(np.array([len(pairs) * 16 // (n - 1)]), 4, bits),
                      _slots(np.array([same * 16 // (n - 1)]), 5, bits)]
    a = np.frombuffer(raw, dtype=np.uint8)
    if len(a) > 2:
        b = a.astype(np.uint32)
        parts.append(_slots(b[:-2] << 16 | b[1:-1] << 8 | b[2:], 6, bits))
    s = np.frombuffer(raw.translate(_SHAPE), dtype=np.uint8)
    if len(s):
        s = s[np.concatenate([[True], s[1:] != s[:-1]])].astype(np.uint32)
    if len(s) > 3:
        parts.append(_slots(s[:-3] << 24 | s[1:-2] << 16 | s[2:-1] << 8 | s[3:], 7, bits))
    return _distinct(np.concatenate(parts))


class Model(NamedTuple):
    ratio: np.ndarray         # log-count ratio of each feature
    weight: np.ndarray
    bias: float
    slope: float              # score = 1 / (1 + exp(-(slope * margin + shift)))
    shift: float

    def margin(self, found: np.ndarray) -> float:
        x = self.ratio[found]
        norm = float(np.sqrt(x @ x))
        return float(self.weight[found] @ x) / norm + self.bias if norm else self.bias

    def score(self, found: np.ndarray) -> float:
        z = self.slope * self.margin(found) + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
            epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min |w|^2/2 + cost * sum hinge(y (w x + b)),
    the bias as a constant feature. Returns weights and bias."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(ratio)), 0.0
    values = []
    for found in rows:
        x = ratio[found]
        norm = np.sqrt(x @ x)
        values.append((x / norm if norm else x).astype(np.float32))
    square = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            found, x = rows[i], values[i]
            gradient = y[i] * (w[found] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[found] += step * x
                bias += step
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic fit (Platt's targets, Newton steps)."""
    pos, neg = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p) + 1e-12
        h = np.array([[(v * margins * margins).sum() + 1e-3, (v * margins).sum()],
                      [(v * margins).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(ratio: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, share: float) -> Model:
    """Fit on the sample; ``share`` of label 1 is the score if a class is missing."""
    y = labels * 2.0 - 1.0
    if not len(rows) or len(set(labels.tolist())) < 2:
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model(ratio, np.zeros(len(ratio)), 0.0, 1.0, float(np.log(p / (1 - p))))
    margins = np.zeros(len(rows))
    for fold in range(3):
        out = np.arange(len(rows)) % 3 == fold
        w, b = descend([r for r, o in zip(rows, out) if not o], y[~out], ratio)
        part = Model(ratio, w, b, 1.0, 0.0)
        margins[out] = [part.margin(r) for r, o in zip(rows, out) if o]
    slope, shift = calibrate(margins, labels)
    w, b = descend(rows, y, ratio)
    return Model(ratio, w, b, slope, shift)


def _evidence(rows: DataFrame, keep_below: tuple[float, float], bits: int) -> DataFrame:
    """From ``text, label, h`` (h uniform in 0..1): each task's feature counts,
    and the features of the rows with h below their class's limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), dtype=np.int64)
        schema = pa.schema([("feature", pa.int32()), ("neg", pa.int64()), ("pos", pa.int64()),
                            ("h", pa.float64()), ("found", pa.list_(pa.int32()))])
        for batch in batches:
            sample = []
            for raw, label, h in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist(),
                                     batch.column(2).to_pylist(), strict=True):
                found = indicators(raw, bits)
                counts[label, found] += 1
                if h < keep_below[label]:
                    sample.append({"neg": 1 - label, "pos": label, "h": h, "found": found})
            if sample:
                yield pa.RecordBatch.from_pylist(sample, schema=schema)
        seen = np.flatnonzero(counts.any(axis=0))
        if len(seen):
            nulls = [pa.nulls(len(seen), pa.float64()), pa.nulls(len(seen), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.astype(np.int32)), pa.array(counts[0, seen]), pa.array(counts[1, seen]),
                 *nulls], schema=schema)

    return rows.mapInArrow(run, "feature int, neg long, pos long, h double, found array<int>")


def train(docs: DataFrame, labels: DataFrame, training: Column, bits: int = BITS,
          fit_rows: int = FIT_ROWS) -> Model:
    """Fit to the labelled rows of ``docs`` where ``training`` holds."""
    spark = docs.sparkSession
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    h = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(SEED)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    # labels grow with the documents: a shuffle join at every size
    rows = (docs.where(training).select("doc_id", "text").join(known.hint("merge"), "doc_id")
            .select("text", "label", h.alias("h")))
    joined = (docs.where(training).select("doc_id").join(known.hint("merge"), "doc_id")
              .groupBy("label").count().collect())
    total = [0, 0]
    for r in joined:
        total[r["label"]] = r["count"]
    bound = [min(n, max(fit_rows // 2, fit_rows - rest)) for n, rest in zip(total, total[::-1])]
    # twice the bound in expectation, then exactly the smallest
    table, path = write_table(_evidence(rows, tuple(2.0 * b / max(1, n) for b, n in zip(bound, total)), bits),
                              "evidence")
    sums = (table.where(F.col("feature").isNotNull()).groupBy("feature")
            .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    counts = np.zeros((2, 1 << bits))
    for batch in sums.toArrow().to_batches():       # at most 2**bits rows
        at = batch.column("feature").to_numpy()
        counts[0, at], counts[1, at] = batch.column("neg").to_numpy(), batch.column("pos").to_numpy()
    drawn = table.where(F.col("h").isNotNull()).select("h", "pos", "found")
    drawn = [drawn.where(F.col("pos") == label).orderBy("h", F.xxhash64("found")).limit(bound[label]).toArrow()
             for label in (0, 1)]
    sample = pa.concat_tables(drawn)
    drop_table(spark, path)
    rows_in = []
    for chunk in sample.column("found").chunks:
        values, edge = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        rows_in += [values[s:e] for s, e in zip(edge[:-1], edge[1:])]
    marks = np.array(sample.column("pos").to_pylist(), dtype=np.int64)
    order = np.argsort(sample.column("h").to_numpy(), kind="stable")     # classes mixed
    rows_in, marks = [rows_in[i] for i in order], marks[order]
    q, p = counts + 1.0
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[counts.sum(axis=0) == 0] = 0.0            # never seen: no evidence
    model = fit(ratio, rows_in, marks, float(marks.mean()) if len(marks) else 0.5)
    if not 0 < marks.sum() < len(marks):
        return model
    # the sample's odds of label 1 against those of all training rows
    odds = np.log(total[1] / total[0]) - np.log(marks.sum() / (len(marks) - marks.sum()))
    return model._replace(shift=model.shift + float(odds))


def score_documents(docs: DataFrame, model: Model, bits: int = BITS) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([model.score(indicators(raw, bits)) for raw in raw_texts(batch.column(1))],
                         pa.float64())]

    scored = append_columns(docs.select("doc_id", "text"), run, [T.StructField("score", T.DoubleType())])
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learns from the labelled rows
    that are not held out, scores every row."""
    model = train(docs, labels, id_remainder(F.col("doc_id"), HELD_OUT) != 0)
    return score_documents(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", "predicted")
