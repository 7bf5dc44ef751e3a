from collections import Counter

import pytest

from tessera import word_count_normalized, word_count_raw

LINES = [
    ("", [""], []),
    ("   ", [], []),
    ("a b ", ["a", "b"], ["a", "b"]),
    (" a  b", ["", "a", "", "b"], ["a", "b"]),
    ("The 'quick' brown-fox, (a_b)", ["The", "'quick'", "brown-fox,", "(a_b)"],
     ["the", "quick", "brown", "fox", "a", "b"]),
    ("x@y 5%", ["x@y", "5%"], ["x@y", "5%"]),
    ("tab\tinside x", ["tab\tinside", "x"], ["tab", "inside", "x"]),
]


def counts(df):
    return {r.word: r.cnt for r in df.collect()}


@pytest.mark.parametrize("line,raw,norm", LINES)
def test_each_line(spark, line, raw, norm):
    lines = spark.createDataFrame([(line,)], "value string")
    assert counts(word_count_raw(lines)) == dict(Counter(raw))
    assert counts(word_count_normalized(lines)) == dict(Counter(norm))


def test_all_lines_together(spark):
    lines = spark.createDataFrame([(x[0],) for x in LINES], "value string")
    raw = Counter(w for x in LINES for w in x[1])
    norm = Counter(w for x in LINES for w in x[2])
    assert counts(word_count_raw(lines)) == dict(raw)
    assert counts(word_count_normalized(lines)) == dict(norm)


def test_counts_are_bigint(spark):
    lines = spark.createDataFrame([("a a",)], "value string")
    assert dict(word_count_raw(lines).dtypes)["cnt"] == "bigint"
