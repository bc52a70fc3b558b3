import pytest


@pytest.fixture
def frame(spark):
    """Makes a table of documents from (doc_id, text) rows; extra columns by keyword."""
    def make(rows, shape="doc_id long, text string"):
        return spark.createDataFrame([tuple(r) for r in rows], shape)
    return make
