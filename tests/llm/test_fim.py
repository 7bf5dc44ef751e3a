import hashlib
import random
import re

import pytest

from llm.conftest import SF
from tessera.llm import fim
from tessera.llm.common import table


def brute(doc_id, text):
    """The contract in plain Python, without pieces."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hexed = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def text_of(rng, lines):
    return "".join(rng.choice(["é", "a<", "<P", "S>", "b c ", ">M<", "漢字", "\r", "\x0b"]) * rng.randint(0, 9)
                   + "\n" for _ in range(lines)) + rng.choice(["", "tail", "<"])


@pytest.mark.parametrize("piece_bytes", [3, 17, fim.PIECE_BYTES])
def test_digests_equal_brute_force(spark, docs, piece_bytes):
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.randint(0, 30))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n\n"), (204, "has <M> in it\nx"), (None, "a\nb\nc"),
             (205, "same\nrow\n"), (205, "same\nrow\n"), (205, "same\nrow\n"), (206, "one line")]
    out = sorted(map(tuple, fim.digests(docs(rows), piece_bytes=piece_bytes).collect()), key=repr)
    assert out == sorted((brute(*r) for r in rows), key=repr)


def test_very_long_text_and_one_very_long_line(spark, docs):
    rows = [(1, "x" * 3_000_000), (2, "line of text é\n" * 200_000), (3, "\n" * 300_000)]
    out = sorted(map(tuple, fim.digests(docs(rows)).collect()))
    assert out == sorted(brute(*r) for r in rows)


def test_outputs_are_the_examples(spark, docs):
    rows = [(i, "".join(f"line {j}\n" for j in range(i))) for i in range(12)] + [(50, "<P>")]
    out = {r.doc_id: r for r in fim.outputs(fim.pieces(docs(rows), piece_bytes=8)).collect()}
    for i, text in rows:
        assert hashlib.sha256(out[i].output.encode()).hexdigest() == brute(i, text)[5]
        assert out[i].form == brute(i, text)[2]


def test_empty_table(spark, docs):
    assert fim.digests(docs([(1, "a")]).limit(0)).collect() == []


def test_reader_finds_marks_over_pieces():
    for form, marks in fim._MARKS_OF.items():
        parts = {b"<P>": b"a<<S<P", b"<S>": b"M><", b"<M>": b"<<M"}
        raw = b"".join(m + parts[m] for m in marks) or b"plain <P> text"
        for cut in range(1, len(raw)):
            reader, got = fim.Reader(form), {0: b"", 1: b"", 2: b""}
            for at in range(0, len(raw), cut):
                for part, piece in reader.feed(raw[at:at + cut]):
                    got[part] += piece
            for part, piece in reader.close():
                got[part] += piece
            want = {0: b"a<<S<P", 1: b"<<M", 2: b"M><"} if marks else {0: raw, 1: b"", 2: b""}
            assert got == want


def test_one_shuffle_and_whole_table(spark):
    frame = fim.digests(table(spark, SF, "documents"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    out = sorted(map(tuple, frame.collect()))
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert out == sorted(brute(*r) for r in rows)
