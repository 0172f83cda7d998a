import pytest

pytest.importorskip("agencylens.llm")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, lang[, source]]), with a column whose name operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).selectExpr("*", "1 AS size", "'x' AS doc", "2 AS score", "3L AS fp", "4 AS bin", "5 AS root", "6 AS shard")

    return make
