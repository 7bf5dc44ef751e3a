import hashlib
import tracemalloc

import duckdb
from pyspark.sql import functions as F

from llm.conftest import SF
from tessera.llm import chat
from tessera.llm.catalog import ORACLE_SQL, op8_prefix_targets

ODD = ["", "plain", "a\\b", "<|", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nx", "\\<|", "<\\|", "x<", "\\", "\n",
       "end\\\\", "<<|", "é🙂 ", "\\n"]


def test_escapes_are_reversible_and_hide_the_marks(spark):
    rows = spark.createDataFrame([(t,) for t in ODD], "text string").select(
        "text", chat.escape(F.col("text")).alias("escaped"), chat.escape_role(F.col("text")).alias("role")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert chat.unescape(r.escaped) == r.text and chat.unescape_role(r.role) == r.text
        assert "<|" not in r.escaped and "<|" not in r.role and "\n" not in r.role


def conversations(spark, rows):
    return spark.createDataFrame(
        [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, target string").repartition(3)


def test_examples_round_trip(spark):
    rows = [(c, t, "assistant" if t % 2 else role, ODD[(c + 3 * t) % len(ODD)])
            for c, role in ((1, "user"), (2, "sys\ntem"), (3, "<|im_start|>")) for t in range(9 + c)]
    out = {}
    for e in chat.expand_targets(conversations(spark, rows)).collect():
        out.setdefault(e.conv_id, []).append(e)
    for c, es in out.items():
        turns = [(r, t) for k, _, r, t in rows if k == c]
        targets = [i for i, (r, _) in enumerate(turns) if r == "assistant"]
        real = sorted((e for e in es if e.target is not None), key=lambda e: e.target)
        assert [e.target for e in real] == targets
        for e in real:
            assert list(chat.read_turns(e.text)) == turns[:e.target + 1]
            assert chat.unescape(e.text[e.loss_start:e.loss_end]) == turns[e.target][1]
        last = [e for e in es if e.last]
        assert len(last) == 1 and list(chat.read_turns(last[0].text)) == turns
        assert (last[0].target is None) == (turns[-1][0] != "assistant")


def test_nulls_repeats_long_and_empty(spark):
    rows = [(None, 1, "user", "q"), (None, None, "assistant", None), (5, 2, None, "x"), (6, 0, "assistant", "r"),
            (6, 0, "assistant", "r"), (7, 0, "user", "y" * 300000)] + [(8, i, "assistant", "z" * 50) for i in range(500)]
    got = {r.conv_id: r for r in chat.digests(conversations(spark, rows)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[None].n_turns == 2 and got[None].turns_sha256 == sha("assistant\n\nuser\nq\n")
    assert got[5].loss_chars == 0 and got[5].loss_sha256 == sha("") and got[5].turns_sha256 == sha("\nx\n")
    assert got[6].n_turns == 2 and got[6].loss_sha256 == sha("rr")
    assert got[8].loss_chars == 25000 and got[8].loss_sha256 == sha("z" * 25000)
    assert chat.digests(conversations(spark, rows).where("false")).count() == 0
    assert chat.expand_targets(conversations(spark, rows).where("false")).count() == 0


def test_digests_are_those_of_the_assembled_examples(spark):
    rows = [(c, t, ("assistant", "user", "sys\ntem")[(t * t + c) % 3], ODD[(c + 5 * t) % len(ODD)])
            for c in range(12) for t in range(c + 1)]
    got = {r.conv_id: r for r in chat.digests(conversations(spark, rows)).collect()}
    whole = {}
    for e in chat.expand_targets(conversations(spark, rows)).collect():
        whole.setdefault(e.conv_id, []).append(e)
    assert got.keys() == whole.keys()
    for c, es in whole.items():
        es.sort(key=lambda e: (len(e.text), e.last))
        assert all(y.text.startswith(x.text) for x, y in zip(es, es[1:]))
        turns = "".join(f"{r}\n{t}\n" for r, t in chat.read_turns(es[-1].text))
        loss = "".join(chat.unescape(e.text[e.loss_start:e.loss_end]) for e in es)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[c].turns_sha256 == sha(turns) and got[c].loss_sha256 == sha(loss)
        assert got[c].loss_chars == len(loss) and got[c].formatted_chars == sum(len(e.text) for e in es)


def test_a_hot_conversation_is_streamed(spark):
    n = 200_000
    rows = spark.range(n).select(
        F.lit(None).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
        F.concat(F.col("id").cast("string"), F.lit(" words" * 10)).alias("text"))
    (got,) = chat.digests(rows).collect()
    text = [f"{i}" + " words" * 10 for i in range(n)]
    turns = "".join(f"{('user', 'assistant')[i % 2]}\n{t}\n" for i, t in enumerate(text))
    assert got.n_turns == n and got.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256("".join(text[1::2]).encode()).hexdigest()
    sizes = [len(f"<|im_start|>{('user', 'assistant')[i % 2]}\n{t}<|im_end|>\n") for i, t in enumerate(text)]
    total, formatted = 0, 0
    for i, size in enumerate(sizes):
        total += size
        formatted += total * (i % 2)
    assert got.formatted_chars == formatted


def test_reading_back_holds_one_turn():
    piece = f"{chat.START}assistant\n{'x' * 1000}{chat.END}\n"
    head = len(chat.START) + len("assistant\n")
    size, n = len(piece), 20_000
    turns = (chat.Turn(1, piece, i * size, i * size + head, i * size + head + 1000, i == n - 1) for i in range(n))
    tracemalloc.start()
    (got,) = chat.read_back(turns)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["n_turns"] == n and got["formatted_chars"] == size * n * (n + 1) // 2
    assert peak < 1_000_000


def test_clashing_columns_are_ignored(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    plain = conversations(spark, rows).drop("target")
    more = plain.withColumns({c: F.lit("z") for c in ("piece", "begin", "last", "head", "body", "chars", "end")})
    assert chat.digests(more).collect() == chat.digests(plain).collect()
    assert chat.expand_targets(more).collect() == chat.expand_targets(plain).collect()


def test_query_matches_oracle_also_on_odd_texts(spark, tmp_path):
    rows = [(c, t, ("user", "assistant", "a\\\nb")[(t + c) % 3], ODD[(c + t) % len(ODD)]) for c in range(20) for t in range(c)]
    conversations(spark, rows).drop("target").write.parquet(str(tmp_path / "conversations.parquet"))
    for sf, glob in ((SF, ""), (str(tmp_path), "/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet{glob}')")
        want = con.execute(ORACLE_SQL["op8_prefix_targets"]).df()
        got = op8_prefix_targets(spark, sf).toPandas()[list(want.columns)]
        assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_digests_are_read_from_the_expanded_examples(spark, monkeypatch):
    # replies in a row, none at all, turns after the last reply
    rows = [(c, t, "assistant" if (t * t + c) % 3 == 1 else "user", ODD[(c + t) % len(ODD)])
            for c in range(9) for t in range(2 * c + 1)] + [(20, t, "user", "no reply") for t in range(5)]
    texts, out = {}, {}
    for e in chat.prefix_targets(conversations(spark, rows)).collect():
        texts[e.conv_id] = texts.get(e.conv_id, "") + e.more
        assert len(texts[e.conv_id]) == e.begin + len(e.more) and e.ends
        out.setdefault(e.conv_id, []).append((e.target, texts[e.conv_id], e.loss_start, e.loss_end, e.last))
    whole = {}
    for e in chat.expand_targets(conversations(spark, rows)).collect():
        whole.setdefault(e.conv_id, []).append((e.target, e.text, e.loss_start, e.loss_end, e.last))
    assert out == whole and out[20][0][0] is None
    # an example that is not expanded is missing from what is read back
    piece = f"{chat.START}assistant\nab{chat.END}\n"
    head = len(chat.START) + len("assistant\n")
    turns = [chat.Turn(1, piece, i * len(piece), i * len(piece) + head, i * len(piece) + head + 2, i == 3) for i in range(4)]
    assert next(chat.read_back(iter(turns)))["loss_chars"] == 8
    expand = chat.targets
    monkeypatch.setattr(chat, "targets", lambda t: (e for e in expand(t) if e.target != 1))
    assert next(chat.read_back(iter(turns)))["loss_chars"] == 6


def test_a_long_run_without_replies_is_cut_into_rows(monkeypatch):
    monkeypatch.setattr(chat, "_BATCH_CHARS", 100)
    piece = f"{chat.START}user\nab{chat.END}\n"
    turns = [chat.Turn(1, piece, i * len(piece), None, None, i == 49) for i in range(50)]
    rows = list(chat.targets(iter(turns)))
    assert len(rows) > 10 and all(len(r.more) < 100 + 2 * len(piece) for r in rows)
    assert [r.ends for r in rows] == [False] * (len(rows) - 1) + [True]
    (e,) = chat.examples(iter(rows))
    assert e.text == piece * 50 and e.last and e.target is None
    (got,) = chat.read_back(iter(turns))
    assert got["n_turns"] == 50 and got["formatted_chars"] == 50 * len(piece) and got["loss_chars"] == 0


def test_digests_read_every_example_written_out_whole(spark, monkeypatch):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {t}") for c in (1, 2) for t in range(7)]
    (plain, _) = chat.digests(conversations(spark, rows)).collect()
    # a change in the prefix of the examples as they are written is read by the query
    write = chat.examples

    def marked(found):
        for e in write(found):
            yield e._replace(text=e.text.replace("text 0", "text zero"), loss_start=e.loss_start + 3, loss_end=e.loss_end + 3)

    monkeypatch.setattr(chat, "examples", marked)
    (got, _) = chat.digests(conversations(spark, rows)).collect()
    turns = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:7])
    assert plain.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256(turns.replace("text 0", "text zero").encode()).hexdigest()
    assert got.formatted_chars == plain.formatted_chars + 4 * 3 and got.loss_sha256 == plain.loss_sha256


def test_written_examples_read_as_what_they_add():
    turns, n = [], 4_000
    for i in range(n):
        head, body = f"{chat.START}{'assistant' if i % 2 else 'user'}\n", f"{i} é🙂" * (i % 5)
        begin = turns[-1].begin + len(turns[-1].piece) if turns else 0
        at = (begin + len(head), begin + len(head) + len(body)) if i % 2 else (None, None)
        turns.append(chat.Turn(1, f"{head}{body}{chat.END}\n", begin, *at, i == n - 1))
    (whole,) = chat.read_written(chat.examples(chat.targets(iter(turns))))
    assert whole == next(chat.read_back(iter(turns))) and whole["n_turns"] == n
    assert whole["formatted_chars"] == sum(t.begin + len(t.piece) for t in turns[1::2])
