import pytest


@pytest.fixture()
def docs(spark):
    """Makes a documents table with an extra column whose name clashes with inner ones."""

    def make(rows, extra="node"):
        full = [(i, t, "x") for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {extra} string")

    return make
