"""Fill-in-the-middle examples by secondary sort.

A text is cut into lines; two cuts, hashed from its ``doc_id``, make prefix,
middle and suffix, and the output puts them in the order of its form, behind
the marks ``<P>``, ``<S>`` and ``<M>``.

1. *Pieces.* Each text gives its output in pieces of whole units, up to
   ``PIECE_BYTES`` each (a longer unit is cut), keyed by row and output position.
2. *Secondary sort.* The pieces are dealt out by row and sorted within the
   partitions by ``(row, position)``: ``repartition`` with ``sortWithinPartitions``,
   the DataFrame form of ``repartitionAndSortWithinPartitions``. The sort spills,
   so a task holds one piece at a time, not a document.
3. *Streams.* A task streams over the pieces, updates a document's digest and
   reads its output back: the marks found in the stream say which part a byte
   belongs to. The parts are sorted again, now by their place in the text (same
   rows, same partitions: no second shuffle), and streamed into the digest
   of the restored text.

Rows are numbered where the table is scanned, so ``docs`` should be read from
files, whose splits are the same when a task is repeated.

Defined results: a null text is empty; an empty text is plain with no units; a
null ``doc_id`` counts as no digits; a text that holds a mark is plain; repeated
rows give one example each; an empty table gives an empty result; other columns
are ignored. A very long text is split into pieces in the task that reads it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import raw_texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM_RATE = 7, 100, 50
PIECE_BYTES = 1 << 16

# Part of a restored text, in its order; the row of a document's facts is last.
_PARTS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_FACTS = 3
_MARKS_OF = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}
_UNIT = re.compile(rb"[^\n]*\n|[^\n]+")

_PIECES = ("row long, place int, position long, doc_id long, n long, form string, "
           "prefix_chars long, middle_chars long, piece binary")


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def _chars(raw: bytes) -> int:
    return len(raw.decode("utf-8", "replace"))


def split(doc_id: int | None, raw: bytes, seed: int = SEED, rate: int = RATE,
          spm_rate: int = SPM_RATE) -> tuple[int, str, list[list[bytes]]]:
    """``n, form, parts``: the units of prefix, middle and suffix (of a plain
    text, all are in the first)."""
    units = _UNIT.findall(raw)
    n = len(units)
    h1, h2, h3, h4 = _draws(doc_id, seed)
    if not raw or any(m in raw for m in _PARTS) or h3 % 100 >= rate:
        return n, "plain", [units, [], []]
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < spm_rate else "psm"
    return n, form, [units[:low], units[low:high], units[high:]]


def _chunks(mark: bytes, units: list[bytes], limit: int) -> Iterator[bytes]:
    """``mark`` and units joined to pieces of at most ``limit`` bytes."""
    held, size = [mark], len(mark)
    for unit in units:
        for at in range(0, len(unit), limit):
            part = unit[at:at + limit]
            if size + len(part) > limit:
                yield b"".join(held)
                held, size = [], 0
            held.append(part)
            size += len(part)
    yield b"".join(held)


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
           piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The outputs of ``docs`` as pieces, dealt out by row and sorted by output
    position within their partitions: ``row, position, piece`` and the facts
    ``doc_id, n, form, prefix_chars, middle_chars`` on each row's first piece
    (its ``form`` on all). ``place`` is 0."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("position", pa.int64()),
                        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("piece", pa.binary())])

    def of(row: int, doc_id: int | None, raw: bytes) -> Iterator[tuple]:
        n, form, parts = split(doc_id, raw, seed, rate, spm_rate)
        marks = _MARKS_OF[form]
        chars = [None if form == "plain" else _chars(b"".join(parts[i])) for i in (0, 1)]
        facts = (doc_id, n, form, *chars)
        at = 0
        for mark, units in ([(m, parts[_PARTS[m]]) for m in marks] or [(b"", parts[0])]):
            for piece in _chunks(mark, units, piece_bytes):
                yield (row, 0, at, *(facts if at == 0 else (None, None, form, None, None)), piece)
                at += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            yield from _batches((r for row, doc_id, raw in zip(numbers, ids, raw_texts(batch.column(2)))
                                 for r in of(row, doc_id, raw)), schema, piece_bytes)

    return (rows.mapInArrow(run, _PIECES)
            .repartition("row").sortWithinPartitions("row", "position"))


def _batches(rows: Iterable[tuple], schema: pa.Schema, piece_bytes: int) -> Iterator[pa.RecordBatch]:
    """Record batches of ``rows``, whose last value is the piece, of a bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"") + 64
        if size > 64 * piece_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)],
                                             schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)],
                                         schema=schema)


class Reader:
    """Reads an output back piece by piece: ``feed`` gives ``(part, bytes)``.

    The next mark is looked for in what was not given out yet; the last bytes
    are held back, as a mark may run over two pieces."""

    def __init__(self, form: str):
        self.marks = list(_MARKS_OF[form])
        self.part, self.rest = 0, b""

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        self.rest += piece
        while self.marks:
            at = self.rest.find(self.marks[0])
            if at < 0:
                keep = len(self.rest) - len(self.marks[0]) + 1
                if keep > 0:
                    yield self.part, self.rest[:keep]
                    self.rest = self.rest[keep:]
                return
            if at:
                yield self.part, self.rest[:at]
            mark = self.marks.pop(0)
            self.part, self.rest = _PARTS[mark], self.rest[at + len(mark):]
        if self.rest:
            yield self.part, self.rest
            self.rest = b""

    def close(self) -> Iterator[tuple[int, bytes]]:
        if self.rest:
            yield self.part, self.rest


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def restored(sorted_pieces: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The texts read back from ``sorted_pieces`` (of :func:`pieces`), sorted
    by their place in the text: pieces, and a last row for each document with its
    facts and, as ``piece``, the SHA-256 of its output."""
    schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("position", pa.int64()),
                        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("piece", pa.binary())])
    empty = (None, None, None, None, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        row = facts = digest = reader = None
        at = 0

        def end() -> Iterator[tuple]:
            for part, raw in reader.close():
                yield row, part, at, *empty, raw
            yield row, _FACTS, 0, *facts, digest.digest()

        for number, _, _, *told, piece in _records(batches):
            if number != row:
                if row is not None:
                    yield from end()
                row, facts, at = number, told, 0
                digest, reader = hashlib.sha256(), Reader(told[2])
            digest.update(piece)
            for part, raw in reader.feed(piece):
                yield row, part, at, *empty, raw
                at += 1
        if row is not None:
            yield from end()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(read(batches), schema, piece_bytes)

    return sorted_pieces.mapInArrow(run, _PIECES).sortWithinPartitions("row", "place", "position")


def digests(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
            piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256`` of every row: the output's digest, and that of the text
    rebuilt from it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256()
        for batch in batches:
            out = []
            for _, place, _, doc_id, n, form, prefix, middle, piece in _records(iter([batch])):
                if place == _FACTS:
                    out.append((doc_id, n, form, prefix, middle, piece.hex(), digest.hexdigest()))
                    digest = hashlib.sha256()
                else:
                    digest.update(piece)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _DIGEST_TYPES)], names=_DIGEST_NAMES)

    return restored(pieces(docs, seed, rate, spm_rate, piece_bytes), piece_bytes).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
             "output_sha256 string, restored_sha256 string")


_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_DIGEST_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def outputs(sorted_pieces: DataFrame) -> DataFrame:
    """``row, doc_id, form, output``: the examples as texts, one row for each
    document, for texts that fit a row (as those of ``docs`` do)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, facts, held = None, None, []

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row], pa.int64()), pa.array([facts[0]], pa.int64()), pa.array([facts[2]]),
                 pa.array([b"".join(held).decode("utf-8", "replace")])],
                names=["row", "doc_id", "form", "output"])

        for number, _, _, *told, piece in _records(batches):
            if number != row:
                if row is not None:
                    yield one()
                row, facts, held = number, told, []
            held.append(piece)
        if row is not None:
            yield one()

    return sorted_pieces.mapInArrow(run, "row long, doc_id long, form string, output string")
