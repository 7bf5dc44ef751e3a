import pathlib

import duckdb

import corpus_pipeline
from llm.conftest import SF
from llm.test_decontaminate import brute as brute_contaminated
from llm.test_mixing import brute_targets
from llm.test_simhash import brute_components, brute_fingerprint
from tessera.llm import pii
from tessera.llm.catalog import ORACLE_SQL
from tessera.llm.common import table
from tessera.session import ensure_checkpoint_dir


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "pii", "mixture"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_whole_run_against_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    keep = {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({ORACLE_SQL['op2_host_rules']})").fetchall() if kept}
    rows = {r.doc_id: r for r in table(spark, SF, "documents").collect() if r.doc_id in keep}
    groups = brute_components({i: brute_fingerprint(r.text) for i, r in rows.items()})
    rows = {i: r for i, r in rows.items() if groups[i] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {d for d, _, _ in brute_contaminated([(i, r.text) for i, r in rows.items()], items)}
    assert bad and len(keep) < 200
    rows = {i: r for i, r in rows.items() if i not in bad}
    size = {i: len(pii.mask_text(r.text).encode().split()) for i, r in rows.items()}
    per = {}
    for i, r in rows.items():
        per[r.source] = per.get(r.source, 0) + size[i]
    targets = brute_targets(per)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(rows)
    taken = {}
    for i, r in out.items():
        s = rows[i].source
        assert (r.size, r.source_size) == (size[i], per[s])
        assert abs(r.target - targets[s]) < 1e-6 * targets[s]
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(size[i] for i in rows if rows[i].source == s)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean, "en", "a", 5, "x"), (1, clean, "en", "a", 5, "x"), (2, None, None, None, None, None),
            (None, clean + " tail", "en", None, None, "y"), (3, "", "en", "a", 0, "z"),
            (4, "mail me at a@b.co " + " ".join(f"other{i}" for i in range(40)), "en", "b", 9, None),
            (5, " ".join(f"long{i}" for i in range(40000)), "de", "b", 1, "n")]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    for empty in (False, True):
        kept = docs.where("false") if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns, name
        texts = {r.doc_id: r.text for r in kept.collect()}
        if not empty:
            assert set(texts) in ({1, 4, 5}, {1, 4, 5, None}) and texts[4].startswith("mail me at [EMAIL] ")
        mixed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
        assert mixed.count() == len(texts)


def test_the_corpus_holds_the_masked_texts_of_the_run(spark, tmp_path):
    taken = {r.doc_id: r.copies for r in corpus_pipeline.run(spark, SF).collect() if r.copies}
    path = str(tmp_path / "corpus")
    out = corpus_pipeline.write_corpus(spark, SF, path)
    source = table(spark, SF, "documents")
    assert out.columns == [*source.columns, "copies"]
    texts = {r.doc_id: r.text for r in source.collect()}
    rows = out.collect()
    assert {r.doc_id: r.copies for r in rows} == taken and len(rows) == len(taken)
    assert all(r.text == pii.mask_text(texts[r.doc_id]) for r in rows)


def test_a_run_leaves_only_its_result(spark):
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(folder.iterdir()) if folder.exists() else set()
    out = corpus_pipeline.run(spark, SF)
    left = set(folder.iterdir()) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["pipeline"] and out.count() > 0
