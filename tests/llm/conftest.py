import pytest

DOC = "doc_id long, text string"


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents out of texts or (doc_id, text) pairs, in several partitions, with further columns whose names clash."""

    def run(rows, clash=True):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(rows, DOC).repartition(3)
        if clash:
            for name in ("n", "sid", "key", "block", "score", "rid", "size", "component", "range"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return run
