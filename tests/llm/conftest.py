import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text), with columns whose names the operators use themselves."""

    def make(rows):
        named = [(i, t, "x", 1, b"y", [1], "z", 2.0) for i, t in rows]
        columns = "doc_id long, text string, gram string, k1 int, key binary, spans array<int>, node string, row double"
        return spark.createDataFrame(named, columns)

    return make
