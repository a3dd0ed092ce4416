import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, repeats, ties, long texts and columns whose names clash with the operators' own."""
    def make(rows):
        """rows: (doc_id, text[, source])"""
        rows = [(*r, None, None)[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        clash = ["d", "th", "row", "spans", "id", "size", "rank", "pos", "shard", "fp", "first", "k0", "u", "_row", "ids"]
        return df.select("*", *[F.lit(f"{c}!").alias(c) for c in clash])
    return make
