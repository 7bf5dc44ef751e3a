"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as
context, then the reply, and only the reply's text is trainable (``loss_start``
to ``loss_end``, code points of the example). If turns follow the last
assistant turn, one more example without a target holds the whole
conversation, so that no turn is lost.

Template: ``<|im_start|>role LF text <|im_end|> LF`` for each turn. Inside roles
and texts a backslash is doubled and ``<|`` becomes ``<`` backslash ``|``, so no
text can open or close a turn; in roles a line feed becomes backslash ``n``.

Spark formats each turn and a window over the conversation adds where it begins
(:func:`formatted_turns`); :func:`prefix_targets` expands them to the examples. The
texts of a conversation's examples are prefixes of one another, so a row holds
what an example adds to the one before it and where that begins: n examples
take the conversation's length on their way, not n times it. :func:`examples` writes every
example's text out from them, prefix and all; :func:`expand_targets` gives these as rows,
:func:`digests` reads each of them back as it is written. Either holds one example, at
most a conversation's whole text. :func:`read_examples` reads the same from the rows alone.

Defined results: a null text or role is empty; turns are ordered by ``turn``
(null first), role, text, and repeated rows are turns of their own; null
``conv_id`` is a conversation; a conversation without assistant turns has one
example without target; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_BATCH_CHARS = 4_000_000     # an output batch is closed at about this size


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


class Turn(NamedTuple):
    conv_id: int | None
    piece: str                   # the formatted turn
    begin: int                   # where it begins in the conversation, 0 for the first turn
    loss_start: int | None       # the reply there, null for other roles
    loss_end: int | None
    last: bool                   # of the conversation


class Target(NamedTuple):
    """An example, by what it adds to the one before it in the conversation. More
    turns than make ``_BATCH_CHARS`` come in several rows, of which the last ``ends`` it."""
    conv_id: int | None
    target: int | None           # position of the reply in the conversation, from 0
    begin: int                   # length of the text before ``more``, 0 for the first row
    more: str                    # whole turns
    loss_start: int | None       # of the whole text; null unless the row ends an example
    loss_end: int | None
    ends: bool
    last: bool                   # holds every turn of the conversation


class Example(NamedTuple):
    conv_id: int | None
    target: int | None           # position of the reply in the conversation, from 0
    text: str
    loss_start: int
    loss_end: int
    last: bool                   # holds every turn of the conversation


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """The :class:`Turn` rows of ``conv_id, turn, role, text`` rows; those of a
    conversation lie in one partition, in order."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head, body = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text"))
    tail = F.lit(f"{END}\n")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumns({"head": F.length(head), "body": F.length(body)})
        .withColumn("chars", (F.col("head") + F.col("body") + F.length(tail)).cast("long"))
        .withColumns({"end": F.sum("chars").over(so_far), "last": F.lead(F.lit(1)).over(order).isNull()})
        .withColumn("begin", F.col("end") - F.col("chars")))
    loss = F.when(F.col("role") == F.lit(TARGET_ROLE), F.col("begin") + F.col("head"))
    return placed.select("conv_id", F.concat(head, body, tail).alias("piece"), "begin", loss.alias("loss_start"),
                         (loss + F.col("body")).alias("loss_end"), "last")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[Turn]:
    for b in batches:
        yield from map(Turn, *(b.column(i).to_pylist() for i in range(len(Turn._fields))))


def targets(turns: Iterator[Turn]) -> Iterator[Target]:
    """Prefix-target expansion of turns in order."""
    parts: list[str] = []        # since the last row
    begin = size = n = 0
    for t in turns:
        if t.begin == 0:
            parts, begin, size, n = [], 0, 0, 0
        parts.append(t.piece)
        size, n = size + len(t.piece), n + 1
        end = t.begin + len(t.piece)
        if t.loss_start is not None:
            yield Target(t.conv_id, n - 1, begin, "".join(parts), t.loss_start, t.loss_end, True, t.last)
        elif t.last:
            yield Target(t.conv_id, None, begin, "".join(parts), end, end, True, True)
        elif size > _BATCH_CHARS:
            yield Target(t.conv_id, None, begin, "".join(parts), None, None, False, False)
        else:
            continue
        parts, begin, size = [], end, 0


def examples(rows: Iterator[Target]) -> Iterator[Example]:
    """The examples written out, each with its whole prefix."""
    text = ""                    # of the conversation so far
    for e in rows:
        if e.begin == 0:
            text = ""
        # grows in place if the example before is no longer held, else the prefix is copied
        text += e.more
        if e.ends:
            yield Example(e.conv_id, e.target, text, e.loss_start, e.loss_end, e.last)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """``role, text`` of every turn of an example."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError("a turn must begin with the start mark")
        line = text.index("\n", at)
        end = text.index(END, line)
        yield unescape_role(text[at + len(START):line]), unescape(text[line + 1:end])
        at = end + len(END) + 1


EXAMPLE = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("target", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("loss_start", T.LongType()),
    T.StructField("loss_end", T.LongType()), T.StructField("last", T.BooleanType())])
_EXAMPLE_ARROW = pa.schema([("conv_id", pa.int64()), ("target", pa.int64()), ("text", pa.string()),
                            ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("last", pa.bool_())])


_TARGET_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("target", pa.int64()), ("begin", pa.int64()), ("more", pa.string()),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("ends", pa.bool_()), ("last", pa.bool_())])


def _batches(rows: Iterator[NamedTuple], text: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``_BATCH_CHARS`` of their column ``text``."""
    out, chars = [], 0
    for row in rows:
        out.append(row._asdict())
        chars += len(getattr(row, text))
        if chars > _BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, chars = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def prefix_targets(conversations: DataFrame) -> DataFrame:
    """The :class:`Target` rows of ``conv_id, turn, role, text`` rows; those of a
    conversation lie in one partition, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(targets(_turns(batches)), "more", _TARGET_ARROW)

    return formatted_turns(conversations).mapInArrow(
        run, "conv_id long, target long, begin long, more string, loss_start long, loss_end long, "
             "ends boolean, last boolean")


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[Target]:
    for b in batches:
        yield from map(Target, *(b.column(i).to_pylist() for i in range(len(Target._fields))))


def expand_targets(conversations: DataFrame) -> DataFrame:
    """The examples of ``conv_id, turn, role, text`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(examples(_targets(batches)), "text", _EXAMPLE_ARROW)

    return prefix_targets(conversations).mapInArrow(run, EXAMPLE)


def read_written(found: Iterator[Example]) -> Iterator[dict]:
    """One row per conversation from the whole texts of its examples: the turns of
    the last one, and what lies under the loss mask of each."""
    loss, chars, formatted = hashlib.sha256(), 0, 0
    for e in found:
        reply = unescape(e.text[e.loss_start:e.loss_end])
        loss.update(reply.encode())
        chars += len(reply)
        formatted += len(e.text)
        if e.last:
            digest, n = hashlib.sha256(), 0
            for role, text in read_turns(e.text):
                digest.update(f"{role}\n{text}\n".encode())
                n += 1
            yield {"conv_id": e.conv_id, "n_turns": n, "turns_sha256": digest.hexdigest(),
                   "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": formatted}
            loss, chars, formatted = hashlib.sha256(), 0, 0
        del e                    # see examples()


def read_examples(rows: Iterator[Target]) -> Iterator[dict]:
    """The rows of :func:`read_written` from what each example adds to the one before
    it, which was read with that one: holds no prefix and writes no example out."""
    for e in rows:
        if e.begin == 0:
            digest, loss, n, chars, formatted = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for role, text in read_turns(e.more):
            digest.update(f"{role}\n{text}\n".encode())
            n += 1
        if not e.ends:
            continue
        reply = unescape(e.more[e.loss_start - e.begin:e.loss_end - e.begin])
        loss.update(reply.encode())
        chars += len(reply)
        formatted += e.begin + len(e.more)
        if e.last:
            yield {"conv_id": e.conv_id, "n_turns": n, "turns_sha256": digest.hexdigest(),
                   "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": formatted}


def read_back(turns: Iterator[Turn]) -> Iterator[dict]:
    """:func:`read_examples` of the examples of turns in order."""
    return read_examples(targets(turns))


def digests(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``, read back from the examples, each written out whole."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in read_written(examples(_targets(batches))):
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return prefix_targets(conversations).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
