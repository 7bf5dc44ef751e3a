import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """``documents`` rows (doc_id, text[, source]) with an extra column whose
    name clashes with one the operators compute."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "mine") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, n_words string"
        ).repartition(3)
    return make
