"""Gapless numbers in an order, without a window over the rows.

Rows are range-partitioned and sorted, stored with their number inside the
partition, and each partition's base is a prefix sum over one count per
partition. Storing fixes the physical order that the numbers depend on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.session import new_work_dir


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, … in ``order`` (nulls first)."""
    by = [F.col(c).asc_nulls_first() for c in order]
    path = new_work_dir(df.sparkSession, "numbered")
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id())
    rows.write.parquet(path)
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    part = F.shiftright("_row", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)       # over one row per partition
    bases = (rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
             .select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return (rows.join(F.broadcast(bases), part == F.col("_part"))
            .withColumn(name, (F.col("_row") - F.col("_first") + F.col("_base") + 1).cast("int"))
            .drop("_row", "_part", "_first", "_base"))
