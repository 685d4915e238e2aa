import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Make a documents table of (doc_id, text) pairs; lang and source null, and columns with clashing names."""

    def make(rows, **more):
        out = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], SCHEMA)
        from pyspark.sql import functions as F

        return out.withColumns({k: F.lit(v) for k, v in more.items()})

    return make
