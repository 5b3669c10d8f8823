import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like frame of (doc_id, text[, source]) rows with columns whose names clash with the operators' own."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", 1, "y") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, key string, n int, score string").repartition(partitions)

    return make


EDGE_TEXTS = [None, "", " \n\t ", "a", "A", "one two", "é", "\x00 \x1c", "  ", "…!?", "日本 語", "x" * 5000]
