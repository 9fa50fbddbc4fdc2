import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text), with extra columns whose names the operators use inside."""

    def docs(rows):
        found = spark.createDataFrame(list(rows), "doc_id long, text string")
        return found.select("doc_id", "text", *(F.lit(None).cast("string").alias(c) for c in ("key", "rest", "n_words", "component_id", "spans", "sign", "range", "copy")))

    return docs
