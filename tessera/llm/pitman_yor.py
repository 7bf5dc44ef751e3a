"""Language-model scoring with a hierarchical Pitman-Yor model.

Restaurants: every context (the previous word, hashed to ``CONTEXTS`` classes)
has one; all share one parent, the unigram restaurant, whose base is uniform
over the vocabulary and one unknown word. With c customers and t tables of a
word, d the discount and theta the strength,

    P(w | u) = (c_uw - d t_uw) / (theta + c_u) + (theta + d t_u) / (theta + c_u) * P(w),

and P(w) alike, with the tables of the context restaurants as its customers.
The seating is sampled by Gibbs sweeps over the whole corpus: with the totals
and P(w) of the sweep before, the customers of every dish are seated one after
another, a new table opening with odds ``(theta + d t_u) P(w)`` against
``n - d t``; then the parent's customers, the tables, are seated alike. The
totals of a sweep are those of its own tables, so that its probabilities add up
to 1 in every context. After ``BURN_IN`` sweeps, the first and the second term
of P(w | u), its back-off weight and P(w) are averaged over ``SAMPLES`` sweeps:
the mean over all pairings of a context seating with a parent seating, which
adds up to 1 as well.

A dish's random numbers are hashed from (word, context, sweep), so the seating
does not depend on partitions. The first ``HEAD`` customers are drawn one by
one. From there, where few tables are to be expected, the place of the next one
is drawn at once, from the product of the chances that none opens; where many
are, blocks of customers are drawn together: with the draws fixed, a customer
opens a table if there are more tables than a bound of its own, so their number
is raised until it holds still, which is where one by one would end. All three
draw from the same distribution.

How it runs:

1. Each task packs its documents, about ``PACK_TOKENS`` tokens at a time: one
   packet per partition of the vocabulary, with the word hashes, and for every
   (word, document, context class) a count. Packets are shuffled by partition
   and written as a table bucketed by it, so the first and the last step read a
   partition's packets in one task without another shuffle.
2. A partition's training counts are written as one row, with its share of the
   restaurant totals: CONTEXTS rows at most, whatever the corpus.
3. A sweep reads these rows, seats, and writes them again with the customers and
   tables of the parent restaurant, and its share of the new totals.
4. The last step repeats all sweeps from their totals, averages, and returns to
   every packet the sums over its documents; these are added up per packet.

All counts cover all training documents; a partition's words are counted there
and nowhere else. Words are identified by 64-bit hashes.

Defined results: a null or empty text is one end token; repeated rows count as
often as they come; null ids are texts like any other (crc32 of the empty
text); without training documents every token is unknown and has probability 1;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_remainder, raw_texts
from tessera.session import drop_table, owned_tables, shuffle_partitions, table_path, write_table

CONTEXTS = 1 << 16        # context restaurants
THETA = 1.0
PARENT_DISCOUNT = 0.5
PACK_TOKENS = 600_000
BURN_IN = 2
SAMPLES = 4
HEAD = 64                 # customers of a dish that are drawn one by one
FEW_TABLES = 16           # new tables are drawn one at a time if fewer are expected,
CELL_COST = 1e-4          # or fewer than this share of the customers
CELLS = 1 << 20           # customers of a block
SEED = 29
HELD_OUT, HELD_REMAINDER = 7, 2

_word = xxhash.xxh64_intdigest


# ---- packets ----------------------------------------------------------------

class Packet(NamedTuple):
    """What one batch of documents says about one partition's words."""
    words: np.ndarray     # uint64, distinct
    runs: np.ndarray      # uint32: entries of each word
    docs: np.ndarray      # uint16: document of the entry, within the batch
    contexts: np.ndarray  # uint16
    counts: np.ndarray    # uint8: 1..255 tokens; more take several entries

    def pack(self) -> bytes:
        return struct.pack("<II", len(self.words), len(self.docs)) + b"".join(
            x.tobytes() for x in self)

    @classmethod
    def unpack(cls, raw: bytes) -> Packet:
        n, m = struct.unpack_from("<II", raw)
        out, at = [], 8
        for kind, length in (("<u8", n), ("<u4", n), ("<u2", m), ("<u2", m), ("u1", m)):
            x = np.frombuffer(raw, dtype=kind, count=length, offset=at)
            out.append(x)
            at += x.nbytes
        return cls(*out)


def tokens(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def _context(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)) % np.uint64(CONTEXTS)


def encode(texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
    """``words`` (distinct hashes), and of every token its place in them, its
    document and its context class. The end token is word 0, all ones; the
    context of a first token is that of the empty word."""
    number: dict[bytes, int] = {}
    length = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t),
                      dtype=np.int64, count=int(length.sum()))
    words = np.fromiter((_word(w) for w in number), dtype=np.uint64, count=len(number))
    words = np.concatenate([[np.uint64((1 << 64) - 1)], words])
    ends = np.cumsum(length + 1) - 1
    place = np.zeros(len(ids) + len(texts), dtype=np.int64)
    inner = np.ones(len(place), dtype=bool)
    inner[ends] = False
    place[inner] = ids + 1
    context = np.empty(len(place), dtype=np.int64)
    context[1:] = _context(words).astype(np.int64)[place[:-1]]
    context[np.concatenate([[0], ends[:-1] + 1])] = int(_context(np.array([_word(b"")], np.uint64))[0])
    return words, place, np.repeat(np.arange(len(texts)), length + 1), context


def packets(texts: list[list[bytes]], parts: list[int]) -> Iterator[tuple[int, Packet]]:
    """Packets of a batch of at most 65,536 documents, by partition."""
    words, place, doc, context = encode(texts)
    n = len(texts)
    # (word, doc, context) in one integer: under 2**21 words, 2**16 documents and contexts
    code = (place * n + doc) * CONTEXTS + context
    code, counts = np.unique(code, return_counts=True)
    if counts.max(initial=0) > 255:
        times = (counts + 254) // 255
        code = np.repeat(code, times)
        last = np.cumsum(times) - 1
        split = np.full(len(code), 255, dtype=np.int64)
        split[last] = counts - (times - 1) * 255
        counts = split
    context, rest = code % CONTEXTS, code // CONTEXTS
    doc, place = rest % n, rest // n
    owner = (words % np.uint64(len(parts))).astype(np.int64)
    runs = np.bincount(place, minlength=len(words))
    order = np.argsort(owner, kind="stable")
    edge = np.searchsorted(owner[order], np.arange(len(parts) + 1))
    start = np.concatenate([[0], np.cumsum(runs)])
    for p, name in enumerate(parts):
        mine = order[edge[p]:edge[p + 1]]
        if len(mine):
            r = runs[mine]
            shift = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(r)[:-1]]), r)
            at = shift + np.arange(len(shift))
            yield name, Packet(words[mine], r.astype("<u4"), doc[at].astype("<u2"),
                            context[at].astype("<u2"), counts[at].astype("u1"))


_PACKED = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("data", pa.binary())])


def _pack_rows(parts: list[int]):
    """``doc_id, held, text`` batches to packet rows. A negative part carries
    the batch's list of documents: ids, held-out flags, lengths."""
    def flush(number: int, ids: list, held: list[bool], texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32 | number
        table = pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()),
             pa.array([len(t) + 1 for t in texts], pa.int64())], names=["doc_id", "held", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_batch(table)
        listing = sink.getvalue().to_pybytes()
        flags = np.packbits(np.array(held, dtype=bool)).tobytes()
        rows = [{"part": -1 - batch % 1_000_003, "batch": batch, "data": listing}]
        for p, packet in packets(texts, parts):
            rows.append({"part": p, "batch": batch,
                         "data": struct.pack("<I", len(texts)) + flags + packet.pack()})
        yield pa.RecordBatch.from_pylist(rows, schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, texts, size = 0, [], [], [], 0
        for b in batches:
            for doc_id, out, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                        raw_texts(b.column(2)), strict=True):
                ids.append(doc_id)
                held.append(out)
                texts.append(tokens(raw))
                size += len(texts[-1]) + 1
                if size >= PACK_TOKENS or len(texts) == 65_536:
                    yield from flush(number, ids, held, texts)
                    number, ids, held, texts, size = number + 1, [], [], [], 0
        if texts:
            yield from flush(number, ids, held, texts)
    return run


def _open(raw: bytes) -> tuple[int, np.ndarray, Packet]:
    (n,) = struct.unpack_from("<I", raw)
    flags = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, 4), count=n).astype(bool)
    return n, flags, Packet.unpack(raw[4 + (n + 7) // 8:])


# ---- seating ----------------------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def dish_keys(words: np.ndarray, contexts: np.ndarray, number: int) -> np.ndarray:
    """What a dish's random numbers of sweep ``number`` are hashed from; the
    parent restaurant is context ``CONTEXTS``."""
    with np.errstate(over="ignore"):
        place = _mix(contexts.astype(np.uint64) + np.uint64(SEED << 40 | number << 20))
        return _mix(words.astype(np.uint64) + place)


def uniform(keys: np.ndarray, draw: np.ndarray | int) -> np.ndarray:
    """Number ``draw`` of each key's stream, in (0, 1)."""
    with np.errstate(over="ignore"):
        x = _mix(keys + (np.asarray(draw).astype(np.uint64) + np.uint64(1)) * _STEP)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _gamma_ratio(y: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """log gamma(y) - log gamma(y + odds), for y over about 3."""
    def tail(x):
        return 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5)
    z = y + odds
    return -(y - 0.5) * np.log1p(odds / y) - odds * np.log(z) + odds + tail(y) - tail(z)


def _seat_block(present: np.ndarray, last: np.ndarray, tables: np.ndarray, odds: np.ndarray,
                discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables after the customers that meet ``present`` to ``last`` - 1 others."""
    size = last - present
    start = np.cumsum(size) - size
    dish = np.repeat(np.arange(len(size)), size)
    n = np.arange(len(dish)) - (start - present)[dish]
    o = odds[dish]
    # u < o / (o + n - discount * t), solved for t
    bound = (n + o - o / uniform(keys[dish], n)) / discount
    opens = np.zeros(len(dish), dtype=bool)
    while True:
        before = np.cumsum(opens) - opens
        now = tables[dish] + before - before[start][dish] > bound
        if np.array_equal(now, opens):
            return tables + np.add.reduceat(opens.astype(np.int64), start)
        opens = now


def seat(customers: np.ndarray, odds: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables after ``customers`` (>= 1) sat down one by one: a new table opens
    with weight ``odds`` against ``n - discount * tables`` for n present."""
    tables = np.ones(len(customers), dtype=np.int64)
    live = np.flatnonzero(customers > 1)
    for n in range(1, HEAD):
        if not len(live):
            return tables
        chance = odds[live] / (odds[live] + n - discount * tables[live])
        tables[live] += uniform(keys[live], n) < chance
        live = live[customers[live] > n + 1]
    expected = odds[live] * np.log((customers[live] + odds[live]) / (HEAD + odds[live]))
    many = expected > np.maximum(FEW_TABLES, CELL_COST * customers[live])
    _seat_many(live[many], customers, odds, discount, keys, tables)
    _seat_few(live[~many], customers, odds, discount, keys, tables)
    return tables


def _seat_many(live: np.ndarray, customers: np.ndarray, odds: np.ndarray, discount: float,
               keys: np.ndarray, tables: np.ndarray) -> None:
    present = np.full(len(live), HEAD, dtype=np.int64)
    while len(live):
        # the dishes that fit into a block, or a block of the first one
        some = max(1, int(np.searchsorted(np.cumsum(customers[live] - present), CELLS, "right")))
        at, begin = live[:some], present[:some]
        last = np.minimum(customers[at], begin + CELLS)
        tables[at] = _seat_block(begin, last, tables[at], odds[at], discount, keys[at])
        present[:some] = last
        done = some - int(customers[at[-1]] > last[-1])
        live, present = live[done:], present[done:]


def _seat_few(live: np.ndarray, customers: np.ndarray, odds: np.ndarray, discount: float,
              keys: np.ndarray, tables: np.ndarray) -> None:
    present = np.full(len(live), HEAD, dtype=np.int64)
    while len(live):
        # no table opens up to m customers with chance exp(ratio(m) - ratio(present))
        o, taken = odds[live], discount * tables[live]
        level = np.log(uniform(keys[live], tables[live] + (1 << 40))) + _gamma_ratio(present - taken, o)
        opens = _gamma_ratio(customers[live] - taken, o) < level
        live, o, taken, level, low = live[opens], o[opens], taken[opens], level[opens], present[opens]
        high = customers[live]
        while (high - low > 1).any():
            middle = (low + high) // 2
            below = _gamma_ratio(middle - taken, o) < level
            low, high = np.where(below, low, middle), np.where(below, middle, high)
        tables[live] += 1
        going = customers[live] > high
        live, present = live[going], high[going]


class Totals(NamedTuple):
    """What a partition must know of the others."""
    tokens: int               # N
    vocabulary: int           # V
    discount: float           # of the context restaurants
    customers: np.ndarray     # of each context restaurant
    tables: np.ndarray
    parent_customers: int     # all tables of the context restaurants
    parent_tables: int


class Part(NamedTuple):
    """One partition's training counts."""
    words: np.ndarray         # distinct training words
    unigram: np.ndarray       # tokens of each
    word: np.ndarray          # of each (word, context): place in words
    context: np.ndarray
    count: np.ndarray


def count_part(opened: list[tuple[int, np.ndarray, Packet]]) -> Part:
    words = np.concatenate([np.repeat(p.words, p.runs) for _, _, p in opened] or [np.empty(0, np.uint64)])
    train = np.concatenate([~held[p.docs] for _, held, p in opened] or [np.empty(0, bool)])
    context = np.concatenate([p.contexts for _, _, p in opened] or [np.empty(0, np.uint16)])[train]
    count = np.concatenate([p.counts for _, _, p in opened] or [np.empty(0, np.uint8)])[train]
    distinct, place = np.unique(words[train], return_inverse=True)
    code, type_of = np.unique(place * CONTEXTS + context, return_inverse=True)
    count = np.bincount(type_of, weights=count, minlength=len(code)).astype(np.int64)
    word = code // CONTEXTS
    unigram = np.bincount(word, weights=count, minlength=len(distinct)).astype(np.int64)
    return Part(distinct, unigram, word, code % CONTEXTS, count)


def parent_probability(customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
    """P(w) of the unigram restaurant."""
    d, whole = PARENT_DISCOUNT, THETA + totals.parent_customers
    back = (THETA + d * totals.parent_tables) / whole / (totals.vocabulary + 1)
    return np.maximum(customers - d * tables, 0.0) / whole + back


def sweep(part: Part, p_word: np.ndarray, totals: Totals, number: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gibbs sweep ``number`` of a partition: tables of every (word, context),
    and customers and tables of every word in the parent restaurant."""
    odds = (THETA + totals.discount * totals.tables[part.context]) * p_word[part.word]
    tables = seat(part.count, odds, totals.discount,
                  dish_keys(part.words[part.word], part.context, number))
    customers = np.bincount(part.word, weights=tables, minlength=len(part.words)).astype(np.int64)
    base = (THETA + PARENT_DISCOUNT * totals.parent_tables) / (totals.vocabulary + 1)
    own = seat(customers, np.full(len(customers), base), PARENT_DISCOUNT,
               dish_keys(part.words, np.full(len(part.words), CONTEXTS), number))
    return tables, customers, own


def first_totals(n_tokens: int, vocabulary: int, ones: int, twos: int, customers: np.ndarray,
                 types: np.ndarray) -> Totals:
    """Before any sweep: one table for every (word, context), the discount
    from the numbers of types seen once and twice."""
    discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
    return Totals(n_tokens, vocabulary, discount, customers, types, int(types.sum()), vocabulary)


def first_state(part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`sweep` returns, before any: one table for every dish."""
    return (np.ones(len(part.count), dtype=np.int64),
            np.bincount(part.word, minlength=len(part.words)).astype(np.int64),
            np.ones(len(part.words), dtype=np.int64))


def replay(part: Part, history: Sequence[Totals]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The states before the first sweep and after each whose totals before it
    are in ``history``."""
    state = first_state(part)
    yield state
    for i, totals in enumerate(history):
        _, customers, own = state
        state = sweep(part, parent_probability(customers, own, totals), totals, i + 1)
        yield state


class Model:
    """A partition's averaged probabilities; ``history`` has the totals before
    the first and after every sweep."""

    def __init__(self, part: Part, history: Sequence[Totals]):
        totals = history[0]
        whole = THETA + totals.customers
        self.part = part
        self.word, self.own = np.zeros(len(part.words)), np.zeros(len(part.count))
        self.back, self.unknown = np.zeros(CONTEXTS), 0.0
        for i, (state, after) in enumerate(zip(replay(part, history[:-1]), history, strict=True)):
            if i > BURN_IN:
                tables, customers, own = state
                self.word += parent_probability(customers, own, after) / SAMPLES
                self.own += (part.count - after.discount * tables) / whole[part.context] / SAMPLES
                self.back += (THETA + after.discount * after.tables) / whole / SAMPLES
                self.unknown += float(parent_probability(np.zeros(1), np.zeros(1), after)[0]) / SAMPLES
        self.code = part.word * CONTEXTS + part.context
        size = totals.tokens + totals.vocabulary + 1.0
        self.base, self.base_unknown = np.log10((part.unigram + 1.0) / size), -np.log10(size)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word hash in the partition, and whether it is known."""
        if not len(self.part.words):
            return np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
        place = np.minimum(np.searchsorted(self.part.words, words), len(self.part.words) - 1)
        return place, self.part.words[place] == words

    def probability(self, place: np.ndarray, known: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """P(w | u) of words as :func:`find` gave them after context classes."""
        if not len(self.code):
            return self.back[contexts] * self.unknown
        share = np.where(known, self.word[place], self.unknown)
        want = place * CONTEXTS + contexts
        at = np.minimum(np.searchsorted(self.code, want), len(self.code) - 1)
        own = np.where(known & (self.code[at] == want), self.own[at], 0.0)
        return own + self.back[contexts] * share

    def base_log(self, place: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(self.base):
            return np.full(len(place), self.base_unknown)
        return np.where(known, self.base[place], self.base_unknown)


def _opened(data: pa.ChunkedArray) -> list[tuple[int, np.ndarray, Packet]]:
    return [_open(x) for x in data.to_pylist()]


def _pack_part(p: Part) -> bytes:
    runs = np.bincount(p.word, minlength=len(p.words))
    return struct.pack("<QQ", len(p.words), len(p.count)) + b"".join(
        x.astype(kind).tobytes() for x, kind in
        ((p.words, "<u8"), (p.unigram, "<i8"), (runs, "<i8"), (p.context, "<u2"), (p.count, "<i8")))


def _unpack_part(raw: bytes) -> Part:
    n, m = struct.unpack_from("<QQ", raw)
    out, at = [], 16
    for kind, length in (("<u8", n), ("<i8", n), ("<i8", n), ("<u2", m), ("<i8", m)):
        x = np.frombuffer(raw, dtype=kind, count=length, offset=at)
        out.append(x)
        at += x.nbytes
    words, unigram, runs, context, count = out
    return Part(words, unigram, np.repeat(np.arange(n), runs), context.astype(np.int64), count)


_COUNTED = pa.schema([("context", pa.int64()), ("x", pa.int64()), ("y", pa.int64()),
                      ("data", pa.binary()), ("parent", pa.binary())])
_COUNTED_SQL = "context long, x long, y long, data binary, parent binary"


def _counted(data: bytes, customers: np.ndarray, own: np.ndarray, context: list[int], x: list[int],
             y: list[int]) -> pa.RecordBatch:
    """A partition's counts and parent restaurant as one row, then totals."""
    empty = [None] * len(context)
    parent = customers.astype("<i8").tobytes() + own.astype("<i8").tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in
         zip(([None, *context], [None, *x], [None, *y], [data, *empty], [parent, *empty]), _COUNTED.types,
             strict=True)], schema=_COUNTED)


def _count_rows(part: int, group: pa.Table) -> pa.Table:
    """First step; the totals are per context class its customers and types, and
    as classes -1 and -2 the sums V, N and types seen once and twice."""
    p = count_part(_opened(group.column("data")))
    _, customers, own = first_state(p)
    types = np.bincount(p.context, minlength=CONTEXTS)
    at = np.flatnonzero(types)
    tokens_of = np.bincount(p.context, weights=p.count, minlength=CONTEXTS)[at].astype(np.int64)
    return pa.Table.from_batches([_counted(
        _pack_part(p), customers, own, [-1, -2, *at.tolist()],
        [len(p.words), int((p.count == 1).sum()), *tokens_of.tolist()],
        [int(p.unigram.sum()), int((p.count == 2).sum()), *types[at].tolist()])])


def _sweep_rows(totals: Totals, number: int):
    """Sweep ``number``; the totals are the tables of each class, and as class -1
    those of the parent restaurant."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, parent in zip(b.column(0), b.column(1), strict=True):
                p = _unpack_part(data.as_py())
                customers, own = np.frombuffer(parent.as_py(), "<i8").reshape(2, -1)
                tables, customers, own = sweep(p, parent_probability(customers, own, totals), totals, number)
                by = np.bincount(p.context, weights=tables, minlength=CONTEXTS).astype(np.int64)
                at = np.flatnonzero(by)
                yield _counted(data.as_py(), customers, own, [-1, *at.tolist()],
                               [int(own.sum()), *by[at].tolist()], [0] * (len(at) + 1))
    return run


def _score_parts(history: Sequence[Totals]):
    """Last step: sum the logarithms over each packet's documents."""
    def run(part: int, group: pa.Table) -> pa.Table:
        batches, opened = group.column("batch").to_pylist(), _opened(group.column("data"))
        model = Model(count_part(opened), history)
        out = []
        for n, _, q in opened:
            place, known = (np.repeat(x, q.runs) for x in model.find(q.words))
            prob = model.probability(place, known, q.contexts)
            times = q.counts.astype(np.float64)
            sums = [np.bincount(q.docs, weights=w, minlength=n) for w in
                    (times * np.log10(prob), times * model.base_log(place, known), times * known)]
            used = np.flatnonzero(np.bincount(q.docs, minlength=n))
            out.append(used.astype("<u2").tobytes() + sums[0][used].tobytes() + sums[1][used].tobytes()
                       + sums[2][used].astype("<u4").tobytes())
        return pa.table({"batch": pa.array(batches, pa.int64()), "data": pa.array(out, pa.binary())})
    return run


def _join_scores(batch: int, group: pa.Table) -> pa.Table:
    """Add a batch's sums to its document list."""
    listing, sums = None, []
    for data, is_list in zip(group.column("data").to_pylist(), group.column("is_list").to_pylist(), strict=True):
        if is_list:
            listing = pa.ipc.open_stream(data).read_all()
        else:
            sums.append(data)
    n = listing.num_rows
    score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
    for raw in sorted(sums):               # in a fixed order: sums of doubles
        m = len(raw) // 22
        docs = np.frombuffer(raw, "<u2", m)
        score[docs] += np.frombuffer(raw, "<f8", m, 2 * m)
        base[docs] += np.frombuffer(raw, "<f8", m, 10 * m)
        known[docs] += np.frombuffer(raw, "<u4", m, 18 * m)
    return pa.table({"doc_id": listing.column("doc_id"), "held_out": listing.column("held"),
                     "n_tokens": listing.column("n"), "n_known": pa.array(known),
                     "base_score": pa.array(base), "score": pa.array(score)})


def _sums(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Totals over the partitions; at most CONTEXTS + 2 rows."""
    total = rows.groupBy("context").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()
    return {c: (x, y) for c, x, y in zip(*(total.column(k).to_pylist() for k in ("context", "x", "y")),
                                         strict=True)}


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every row; learns from the rows where ``held_out`` is false."""
    spark = docs.sparkSession
    width = shuffle_partitions(spark)
    # one partition of the vocabulary per bucket: the smallest id that falls there
    ids = spark.range(64 * width).select(F.col("id").cast("int").alias("part"))
    parts = sorted(r.part for r in ids.groupBy(F.pmod(F.hash("part"), F.lit(width)))
                   .agg(F.min("part").alias("part")).collect())
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held"), "text")
    packed = rows.mapInArrow(_pack_rows(parts), "part int, batch long, data binary")
    name = f"tessera_packets_{uuid.uuid4().hex}"
    with owned_tables(spark) as keep:
        try:
            (packed.repartition(width, "part").write.bucketBy(width, "part").sortBy("part")
             .option("path", table_path(spark, "packets")).option("compression", "zstd").saveAsTable(name))
            return keep(_scored(spark.table(name)), "scores")
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _scored(packed: DataFrame) -> DataFrame:
    words = packed.where("part >= 0")

    def per_part(fn, schema: str) -> DataFrame:
        return words.groupBy("part").applyInArrow(
            lambda key, group: fn(key[0].as_py(), group), schema)

    counted, path = write_table(per_part(_count_rows, _COUNTED_SQL), "counts")
    found = _sums(counted.where("context is not null"))
    vocabulary, n_tokens = found.pop(-1, (0, 0))
    ones, twos = found.pop(-2, (0, 0))
    customers, types = np.zeros(CONTEXTS, dtype=np.int64), np.zeros(CONTEXTS, dtype=np.int64)
    for c, (x, y) in found.items():
        customers[c], types[c] = x, y
    history = [first_totals(n_tokens, vocabulary, ones, twos, customers, types)]
    for number in range(1, BURN_IN + SAMPLES + 1):
        parts = counted.where("context is null").select("data", "parent")
        counted, new = write_table(parts.mapInArrow(_sweep_rows(history[-1], number), _COUNTED_SQL), "counts")
        drop_table(packed.sparkSession, path)
        path = new
        found = _sums(counted.where("context is not null"))
        parent_tables = found.pop(-1, (0, 0))[0]
        tables = np.zeros(CONTEXTS, dtype=np.int64)
        for c, (x, _) in found.items():
            tables[c] = x
        history.append(history[0]._replace(tables=tables, parent_customers=int(tables.sum()),
                                           parent_tables=parent_tables))
    drop_table(packed.sparkSession, path)

    sums = per_part(_score_parts(tuple(history)), "batch long, data binary").withColumn("is_list", F.lit(False))
    lists = packed.where("part < 0").select("batch", "data", F.lit(True).alias("is_list"))
    scored = sums.unionByName(lists).groupBy("batch").applyInArrow(
        lambda key, group: _join_scores(key[0].as_py(), group),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scored: DataFrame) -> DataFrame:
    """``held_out, n_docs, n_tokens, perplexity, base_perplexity``."""
    return scored.groupBy("held_out").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"))


def score_documents(docs: DataFrame) -> DataFrame:
    """:func:`score_texts` with the ids of crc32 mod 7 = 2 held out."""
    return score_texts(docs, id_remainder(F.col("doc_id"), HELD_OUT) == HELD_REMAINDER)
