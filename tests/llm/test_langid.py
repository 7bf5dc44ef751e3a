import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import SF
from tessera.llm import langid
from tessera.llm.common import id_remainder, table

TRAINING = [("en", "the cat sat on the mat and the dog ran"), ("en", "the cat and the dog ate"),
            ("de", "die Katze und der Hund und die Maus"), ("de", "der Hund und die Katze"),
            ("el", "η γάτα και ο σκύλος η γάτα"), ("zh", "我们的猫 我们的猫")]


@pytest.fixture(scope="module")
def corpus(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, "s", "clash") for i, t, lang in rows],
            "doc_id long, text string, lang string, source string, lang_pred string").repartition(3)
    return make


def letters_in(text):
    out, word = [], ""
    for c in text + " ":
        if c.isalpha():
            word += c
        elif word:
            out.append(word.lower())
            word = ""
    return out


def brute(rows, text):
    """Scores of a text by plain counting over all training rows."""
    seen = {}
    for lang, t in rows:
        counts = seen.setdefault(lang, [Counter() for _ in range(langid.MAX_GRAM + 1)])
        for w in letters_in(t):
            counts[0][w] += 1
            for n in range(1, langid.MAX_GRAM + 1):
                for i in range(len(w) + 3 - n):
                    counts[n][f" {w} "[i:i + n]] += 1
    totals = {lang: [sum(c.values()) for c in counts] for lang, counts in seen.items()}
    sums = dict.fromkeys(seen, 0.0)

    def share(lang, n, gram):
        c = seen[lang][n][gram]
        if not c or (n == 0 and c < langid.MIN_COUNT):
            return -langid.PENALTY
        return max(math.log10(c / totals[lang][n]), -langid.PENALTY)

    for w in letters_in(text):
        if any(seen[lang][0][w] >= langid.MIN_COUNT for lang in seen):
            for lang in seen:
                sums[lang] += share(lang, 0, w)
            continue
        for n in range(langid.MAX_GRAM, 0, -1):
            grams = [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)]
            grams = [g for g in grams if g.strip() and any(seen[lang][n][g] for lang in seen)]
            if grams:
                for lang in seen:
                    sums[lang] += sum(share(lang, n, g) for g in grams) / len(grams)
                break
    best = max(sorted(sums), key=lambda x: sums[x])
    return best, 1 / sum(10 ** max(v - sums[best], -300) for v in sums.values())


def test_scores_equal_brute_force(corpus):
    model = langid.train(corpus([(i, t, lang) for i, (lang, t) in enumerate(TRAINING)]), F.lit(True))
    scorer = langid.Scorer(model)
    for text in ["the dog", "der Hund", "cats and dogs", "Hunde Mäuse", "γάτες", "我们 猫猫", "thé x²y dog_cat 12dog3",
                 "zzz qqq", "THE DOG! the, dog? ran ran ran", "ate", "η", "catdog mausmaus sat"]:
        want = brute(TRAINING, text)
        got = scorer.text(text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], rel=1e-4), text


def test_defined_results(spark, corpus):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TRAINING)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 ²½ _ --", "de"), (103, "ξψφ ЖЩ", None), (None, "the dog", "en"),
             (104, "the dog", None), (104, "the dog", None)]
    frame = corpus(rows)
    out = {}
    for r in langid.predict(frame, langid.train(frame, F.col("doc_id") < 100)).collect():
        out.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert out[100] == out[101] == out[102] == [("und", 0.0)]
    assert out[None][0][0] == "en" and out[104] == out[104][:1] * 2 and out[104][0][0] == "en"
    nothing = langid.predict(frame, langid.train(frame, F.lit(False)))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    assert langid.classify(frame.limit(0)).collect() == []
    # letters never learnt: an even score, the smallest name
    even = langid.Scorer(langid.train(frame, F.col("doc_id") < 4)).text("ЖЩ")
    assert even == ("de", 0.5)


def test_very_long_text_is_read_in_parts():
    text = ("wort " * 300_000) + "x" * 3_000_000 + " ende"
    assert langid.words(text) == {"wort": 300_000, "x" * 3_000_000: 1, "ende": 1}


def test_sample_is_bounded_and_learns_only_where_told(spark, corpus):
    rows = [(i, f"word{'abcdefghij'[i % 10]} shared", "en") for i in range(400)] + [(i, "mot", "fr") for i in range(400, 440)]
    rows += [(500 + i, "secret", "en") for i in range(50)] + [(7, "same id", "en")] * 500
    frame = corpus(rows)
    drawn = langid.sample(frame, F.col("doc_id") < 500, fit_rows=30).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in drawn}["fr"] == 30
    assert all(r["count"] <= 30 for r in drawn)
    few = langid.sample(frame, F.col("doc_id") < 500, fit_bytes=40).collect()
    assert 0 < sum(len(r.text) for r in few if r.lang == "en") <= 40
    model = langid.train(frame, F.col("doc_id") < 500)
    assert "secret" not in model.words and "shared" in model.words


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    docs = table(spark, sf, "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    out = langid.classify(docs).collect()
    assert len(out) == len(truth)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0.0 <= r.score <= 1.0 for r in out)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held if r.lang_pred != "und"]) > 0.99


def test_prediction_reads_only_the_text(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs, id_remainder(F.col("doc_id"), 3) != 1)
    a = langid.predict(docs, model)
    b = langid.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("q")), model)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
