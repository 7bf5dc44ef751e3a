import random
from fractions import Fraction
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from pyspark.sql import functions as F

from tessera.operators import setsim
from tessera import order_tokens, prefix_index, set_similarity_join, token_frequency
from tessera.plans.catalog import ORACLE_SQL, QUERIES

T = [(0, [1, 4, 5, 6]), (1, [2, 3, 6]), (2, [4, 5, 6]), (3, [1, 4, 6]), (4, [2, 5, 6]),
     (5, [3, 5])]

# 13 records of the 100-record sample (rid, tokens)
FLICKR13 = [
    (0, [148, 235, 243, 311, 519, 681, 741, 885, 933, 966, 990]),
    (3, [26, 149, 177, 327, 1048, 1050, 1059]),
    (20, [51, 60, 596, 695, 987, 1048, 1059]),
    (28, [37, 196, 208, 288, 601, 1045, 1047]),
    (30, [63, 152, 162, 262, 658, 893, 1001, 1005]),
    (58, [241, 526, 598, 616, 770, 1001, 1005]),
    (64, [35, 100, 191, 314, 370, 376, 415, 882, 892, 906, 968, 1029, 1054]),
    (66, [135, 137, 792, 793, 1048, 1059]),
    (72, [20, 74, 115, 200, 303, 331, 480, 968, 1029, 1054]),
    (77, [539, 1019, 1045, 1047]),
    (96, [1063]),
    (97, [123, 283, 725, 757, 1016, 1063]),
    (99, [121, 371, 909, 960, 1063]),
]


def pairs(df):
    return [(r.rid_a, r.rid_b, r.sim) for r in df.collect()]


def brute(records, t):
    out = []
    sets = {rid: set(map(str, toks)) for rid, toks in records}
    for a, b in combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        union = len(sets[a]) + len(sets[b]) - inter
        if union and inter / union >= t:
            out.append((a, b, inter / union))
    return out


def test_token_frequency(sets):
    got = [(r.token, r.freq) for r in token_frequency(sets(T)).collect()]
    assert got == [("1", 2), ("2", 2), ("3", 2), ("4", 3), ("5", 4), ("6", 5)]


def test_token_frequency_counts_repeats_and_orders_numerically(sets):
    got = [(r.token, r.freq) for r in token_frequency(sets([(0, [10, 9, 9]), (1, [10])])).collect()]
    assert got == [("9", 2), ("10", 2)]


def test_token_frequency_long_form(spark):
    long = spark.createDataFrame([(0, "7"), (0, "7"), (1, "3")], "rid long, token string")
    assert [(r.token, r.freq) for r in token_frequency(long).collect()] == [("3", 1), ("7", 2)]


def test_order_tokens(sets):
    got = {r.rid: r.tokens for r in order_tokens(sets(T + [(9, [])])).collect()}
    assert got[0] == ["1", "4", "5", "6"]
    assert got[5] == ["3", "5"]
    assert got[9] == []


def test_order_tokens_long_form(spark, sets):
    long = spark.createDataFrame([(rid, str(t)) for rid, toks in T for t in toks + toks[:1]],
                                 "rid long, token string")
    got = {r.rid: r.tokens for r in order_tokens(long).collect()}
    want = {r.rid: r.tokens for r in order_tokens(sets(T)).collect()}
    assert got == want


def test_prefix_index(sets):
    got = {r.token: r.rids for r in prefix_index(sets(T), 0.5).where("segment = 0").collect()}
    assert got == {"1": [0, 3], "2": [1, 4], "3": [1, 5], "4": [0, 2, 3], "5": [0, 2, 4, 5]}


@pytest.mark.parametrize("t,expected", [
    (0.85, []),
    (0.5, [(0, 2, 0.75), (0, 3, 0.75), (1, 4, 0.5), (2, 3, 0.5), (2, 4, 0.5)]),
    (0.4, [(0, 2, 0.75), (0, 3, 0.75), (0, 4, 0.4), (1, 4, 0.5), (2, 3, 0.5), (2, 4, 0.5)]),
    (0.25, [(0, 2, 0.75), (0, 3, 0.75), (0, 4, 0.4), (1, 4, 0.5), (1, 5, 0.25), (2, 3, 0.5),
            (2, 4, 0.5), (2, 5, 0.25), (4, 5, 0.25)]),
])
def test_tiny_data(sets, t, expected):
    assert pairs(set_similarity_join(sets(T), t)) == expected


@pytest.mark.parametrize("t,expected", [
    (0.5, []),
    (0.2, [(28, 77, Fraction(2, 9)), (96, 99, Fraction(1, 5))]),
    (0.15, [(3, 20, Fraction(2, 12)), (3, 66, Fraction(2, 11)), (20, 66, Fraction(2, 11)),
            (28, 77, Fraction(2, 9)), (30, 58, Fraction(2, 13)), (64, 72, Fraction(3, 20)),
            (96, 97, Fraction(1, 6)), (96, 99, Fraction(1, 5))]),
])
def test_flickr_subset(sets, t, expected):
    got = pairs(set_similarity_join(sets(FLICKR13), t))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
    assert [s for _, _, s in got] == pytest.approx([float(f) for _, _, f in expected])
    assert got == brute(FLICKR13, t)


@pytest.mark.parametrize("t", [0.1, 0.28, 0.5, 0.85, 1.0])
def test_equals_brute_force(sets, t):
    rnd = random.Random(int(t * 100))
    records = []
    for rid in range(60):
        size = rnd.randint(1, 25)
        toks = [rnd.randint(0, 40) for _ in range(size)]
        if rid % 7 == 0 and records:  # near copies
            toks = records[-1][1][:-1] + [rnd.randint(0, 40)]
        records.append((rid, toks))
    assert pairs(set_similarity_join(sets(records), t)) == brute(records, t)


def test_repeated_tokens_count_once(sets):
    got = pairs(set_similarity_join(sets([(1, [5, 5, 5, 6]), (2, [5, 6, 6])]), 1.0))
    assert got == [(1, 2, 1.0)]


def test_empty_record_and_self_pairs(sets):
    got = pairs(set_similarity_join(sets([(1, []), (2, []), (3, [7, 7])]), 0.1))
    assert got == []


def test_threshold_bounds(sets):
    for t in (0.0, -0.5, 1.5):
        with pytest.raises(ValueError):
            set_similarity_join(sets(T), t)


def test_prefix_length_rounding(sets):
    # n=25, t=0.28: 25*0.28 = 7.000000000000001 in floating point. The only
    # shared tokens sit at positions 19..25 of record 1, so its prefix must be
    # 19 long (not 18). Jaccard = 7/25 = 0.28 exactly.
    a = [f"x{i:02d}" for i in range(18)] + [f"y{i}" for i in range(7)]
    b = [f"y{i}" for i in range(7)]
    got = pairs(set_similarity_join(sets([(1, a), (2, b)]), 0.28))
    assert got == [(1, 2, 0.28)]


@pytest.mark.parametrize("t", [0.3, 0.6, 0.8])
def test_equals_brute_force_dense(sets, t):
    # small vocabulary, varied sizes, many pairs close to the threshold
    rnd = random.Random(1000 + int(t * 10))
    base = [rnd.sample(range(80), rnd.randint(5, 60)) for _ in range(8)]
    records = []
    for rid in range(90):
        toks = list(rnd.choice(base))
        for _ in range(rnd.randint(0, max(1, len(toks) // 3))):
            if toks and rnd.random() < 0.5:
                toks.pop(rnd.randrange(len(toks)))
            else:
                toks.append(rnd.randrange(80))
        records.append((rid, toks))
    expected = brute(records, t)
    assert len(expected) > 20
    assert pairs(set_similarity_join(sets(records), t)) == expected


@pytest.mark.parametrize("t", [0.4, 1.0])
def test_groups_of_copies(sets, t):
    # one large group of identical records, a smaller one, near copies and
    # records whose sets differ only in order or repeats
    big = [(rid, [1, 2, 3, 4, 5]) for rid in range(0, 40)]
    small = [(rid, [9, 8, 7]) for rid in (50, 51, 52)]
    near = [(60, [1, 2, 3, 4]), (61, [1, 2, 3, 4, 5, 6]), (62, [7, 8, 9, 10]),
            (63, [5, 4, 3, 2, 1, 1]), (64, [42]), (65, [42, 42])]
    records = big + small + near
    expected = brute(records, t)
    assert len(expected) > 780
    assert pairs(set_similarity_join(sets(records), t)) == expected


@pytest.mark.parametrize("width", [1, 4, 100])
def test_prefix_index_segments(sets, width):
    rids = [rid * 2 ** 40 - 7 for rid in range(30)]
    records = [(rid, [0, 100 + i]) for i, rid in enumerate(rids)]
    rows = prefix_index(sets(records), 0.5, segment_items=width).where("token = '0'").collect()
    assert {r.segment: r.rids for r in rows} == {i // width: rids[i:i + width] for i in range(0, 30, width)}


@pytest.mark.parametrize("t", [0.5, 0.8])
def test_bitmaps_drop_pairs_but_no_similar_one(spark, sets, monkeypatch, t):
    rnd = random.Random(9)
    common = [f"c{i}" for i in range(12)]
    records = [(i, rnd.sample(common, 8) + [f"t{rnd.randrange(3000)}" for _ in range(60)]) for i in range(80)]
    records += [(100 + i, records[i][1][:-3] + [f"n{i}"]) for i in range(40)]
    expected = brute(records, t)
    assert len(expected) >= 40
    with_bits = setsim.similarity_candidates(sets(records), t)
    assert {(a, b) for a, b, _ in expected} <= {(r.rid_a, r.rid_b) for r in with_bits.collect()}
    assert pairs(set_similarity_join(sets(records), t)) == expected
    # the rows of the candidate join, with the bitmaps and with empty ones
    joined = []
    for blind in (False, True):
        if blind:
            monkeypatch.setattr(setsim, "with_bitmap", lambda r, h: r.withColumns(
                {f"bits{j}": F.lit(0).cast("long") for j in range(setsim.BITMAP_LONGS)}))
        joined.append(setsim.similarity_candidates(sets(records), t).count())
    assert joined[0] <= joined[1]


@pytest.mark.parametrize("job", [
    lambda d: set_similarity_join(d, 0.8), lambda d: prefix_index(d, 0.8), order_tokens])
def test_repeated_rid_fails(sets, job):
    x, y = [f"x{i}" for i in range(10)], [f"y{i}" for i in range(10)]
    with pytest.raises(Exception, match="repeated rid"):
        job(sets([(1, x), (1, y), (2, y[:9] + ["z"])])).collect()


@pytest.mark.parametrize("t", [0.4, 1.0])
def test_classes_say_every_pair_without_repeating_copies(sets, t):
    # 60 copies, near ones of them, and a class of its own
    records = ([(rid, [1, 2, 3, 4, 5]) for rid in range(60)] + [(rid, [9, 8, 7]) for rid in (70, 71)]
               + [(80, [1, 2, 3, 4]), (81, [4, 3, 2, 1, 1]), (82, [7, 8, 9, 10]), (83, [42])])
    rows = [tuple(r) for r in setsim.set_similarity_classes(sets(records), t).collect()]
    assert len(rows) < 70                                    # the join has over 1,770
    rep = {b: a for a, b, sim in rows if sim == 1.0}
    linked = {(a, b): sim for a, b, sim in rows if sim < 1.0}
    assert not set(rep.values()) & set(rep) and not any(x in rep for p in linked for x in p)
    every = []
    for i, (a, _) in enumerate(sorted(records)):
        for b, _ in sorted(records)[i + 1:]:
            x, y = sorted((rep.get(a, a), rep.get(b, b)))
            if x == y or (x, y) in linked:
                every.append((a, b, linked.get((x, y), 1.0)))
    assert every == brute(records, t)


def test_parities_never_differ_more_than_the_sets():
    rnd = random.Random(4)
    for _ in range(200):
        x = [rnd.getrandbits(32) - 2 ** 31 for _ in range(rnd.randint(1, 300))]
        y = rnd.sample(x, rnd.randint(0, len(x))) + [rnd.getrandbits(32) - 2 ** 31 for _ in range(rnd.randint(1, 200))]
        batch = pa.RecordBatch.from_pydict({
            "rid": pa.array([1, 2]), "n": pa.array([len(x), len(y)], pa.int32()),
            "h": pa.array([x, y], pa.list_(pa.int32()))})
        (got,) = setsim._parities(iter([batch]))
        a, b = got.column("wide").to_pylist()
        assert setsim.parity_differences(a, b) == setsim.parity_differences(b, a) <= len(set(x) ^ set(y))
        assert setsim.parity_differences(a, a) == 0
        if not set(x) & set(y) and min(len(x), len(y)) > 50:
            assert setsim.parity_differences(a, b) > (len(x) + len(y)) / 3


@pytest.mark.parametrize("hot", [0, 4, 500_000])
def test_join_needs_no_frequency_join_and_any_order_is_lossless(sets, monkeypatch, hot):
    def no(*_):
        raise AssertionError("token rows are joined with their frequencies")
    monkeypatch.setattr(setsim, "_frequency_join", no)
    monkeypatch.setattr(setsim, "HOT_TOKENS", hot)
    rnd = random.Random(21)
    records = [(i, [rnd.randrange(12) for _ in range(rnd.randint(1, 6))]) for i in range(40)]
    # beyond the 128 bits of the bitmap
    long = [rnd.randrange(5000) for _ in range(150)]
    records += [(100 + i, long[i * 12:] + [6000 + i]) for i in range(8)]
    expected = brute(records, 0.5)
    assert len(expected) > 30
    assert pairs(set_similarity_join(sets(records), 0.5)) == expected


def test_the_docs_query_lists_every_pair_of_copies(spark, tmp_path):
    # five copies (one with its words in another order), two near ones, a copy of one of these
    texts = {1: "a b c d e f", 2: "f e d c b a a", 3: "a b c d e f", 4: "a b c d e f", 9: "a b c d e f",
             5: "a b c d e x", 6: "a b c d e y", 7: "a b c d e y", 8: "other words", 10: ""}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = brute([(rid, t.split()) for rid, t in texts.items()], 0.5)
    assert len(want) == 28                       # all pairs of eight documents
    assert sorted(pairs(QUERIES["set_similarity_join_docs"](spark, str(tmp_path)))) == sorted(want)
    assert sorted(con.execute(ORACLE_SQL["set_similarity_join_docs"]).fetchall()) == sorted(want)


def packets(records, t, tokens=(), blocks=(), parts=1):
    """What _packets deals of ``rid, hashes`` records, and what _joined finds there, by part."""
    class Hot:
        value = (np.empty(0, np.int32), np.empty(0, np.int64))

    batch = pa.RecordBatch.from_pydict({
        "rid": pa.array([r for r, _ in records]), "n": pa.array([len(h) for _, h in records], pa.int32()),
        **{f"bits{j}": pa.nulls(len(records), pa.int64()) for j in range(setsim.BITMAP_LONGS)},
        "h": pa.array([h for _, h in records], pa.list_(pa.int32()))})
    prefix = setsim._prefixes(Hot, t)(iter([batch]))
    dealt = pa.Table.from_batches(setsim._packets(np.array(tokens, np.int32), np.array(blocks, np.int64), parts)(prefix))
    out = []
    for part in range(parts):
        mine = dealt.filter(pc.equal(dealt["part"], part)).drop_columns("part").to_batches()
        out.append([(x, y) for b in setsim._joined(t)(iter(mine)) for x, y in zip(*(c.to_pylist() for c in b.columns))])
    return dealt, out


def test_a_pair_leaves_a_task_once_and_chance_pairs_not_at_all():
    rnd = random.Random(12)
    base = [rnd.getrandbits(31) for _ in range(300)]
    records = [(rid, base[rid * 3:] + [rnd.getrandbits(31) for _ in range(3 * rid)]) for rid in range(10)]
    # long records (beyond 128 bits) that have ten tokens of their prefix in common by chance
    few = sorted(base)[:10]
    records += [(100 + i, few + [rnd.getrandbits(31) for _ in range(290)]) for i in range(20)]
    want = {(a, b) for (a, x), (b, y) in combinations(records, 2) if len({*x} & {*y}) >= 0.5 * len({*x} | {*y})}
    dealt, (found,) = packets(records, 0.5)
    assert dealt.num_rows == len(records)        # a record once, not once for each token
    assert len(found) == len(set(found)) and {tuple(sorted(p)) for p in found} == want and len(want) == 45


@pytest.mark.parametrize("parts", [1, 5])
def test_blocks_of_a_hot_token_meet(parts):
    records = [(rid, [7, 1000 + rid, 2000 + rid]) for rid in range(60)]
    every = {p for p in combinations(range(60), 2)}
    for tokens, blocks in (((), ()), ((7,), (4,))):
        dealt, found = packets(records, 0.2, tokens, blocks, parts)
        assert {tuple(sorted(p)) for f in found for p in f} == every
    if parts > 1:        # no part has all records and their pairs
        assert max(map(len, found)) < len(every)


def test_parities_of_many_pairs_are_those_of_each():
    rnd = random.Random(5)
    wide = [rnd.randbytes(8 << rnd.randrange(5)) for _ in range(40)]
    a, b = np.divmod(np.arange(1600), 40)
    got = setsim._Parities(pa.array(wide)).differences(a, b)
    assert got.tolist() == [setsim.parity_differences(wide[i], wide[j]) for i, j in zip(a, b)]


def test_verification_counts_token_strings():
    toks = {1: ["a", "bc", None, ""], 2: ["ab", "c", None, ""], 3: ["a", "bc", "é🙂"], 4: ["x" * 5000]}
    batch = pa.RecordBatch.from_pydict({"rid": list(toks), "toks": pa.array(list(toks.values()), pa.list_(pa.string()))})
    packed = pa.Table.from_batches(setsim._packed(iter([batch]))).column("packed").to_pylist()
    every = list(combinations(toks, 2))
    rows = pa.RecordBatch.from_pydict({
        "rid_a": list(toks) + [a for a, _ in every], "rid_b": pa.array([None] * 4 + [b for _, b in every]),
        "packed": pa.array(packed + [None] * len(every), pa.binary())})
    (got,) = setsim._verified(0.1)(iter([rows]))
    want = {(a, b): len({*x} & {*y}) / len({*x} | {*y}) for (a, x), (b, y) in combinations(toks.items(), 2)}
    assert {tuple(r.values()) for r in got.to_pylist()} == {(*p, s) for p, s in want.items() if s >= 0.1}
