"""Helpers shared by the operators: stored intermediate tables, distributed
numbering by prefix sums, word counting."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.session import new_work_dir
from feedrecon.sources.tables import table  # noqa: F401 (used by the queries)

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet under the shared work folder and read
    back: the lineage is cut, values that depend on the physical layout
    (row numbers) are fixed, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_work_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give what a finished task has freed back to the system: a Python worker
    lives on for later tasks, and its allocator would keep the peak."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # a C library without it keeps the memory
        ctypes.CDLL(None).malloc_trim(0)


def remove(df: DataFrame) -> None:
    """Delete the files behind a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def boxed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as one struct ``row`` (fields ``c0, c1, …`` by
    place), so that no name of the input can clash with an operator's own."""
    fields = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*fields).select(F.struct(*fields).alias("row"))


def field(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df``, as a field of its ``boxed`` row."""
    return F.col(f"row.c{df.columns.index(name)}")


def unboxed(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The input's columns again, by their names; ``changed`` ones replaced, or added at the end."""
    # first the changed ones under names of their own: an expression may not meet an input's name as an alias beside it
    place = {c: f"new{i}" for i, c in enumerate(changed)}
    rows = rows.select("row", *[x.alias(place[c]) for c, x in changed.items()])
    old = [F.col(place[c] if c in place else f"row.c{i}").alias(c) for i, c in enumerate(columns)]
    return rows.select(*old, *[F.col(n).alias(c) for c, n in place.items() if c not in columns])


def numbered(df: DataFrame, order: list[str], group: str | None = None, tag: str = "numbered") -> DataFrame:
    """Gapless ``pos`` from 0 in ``order`` (inside ``group``, which must then
    lead ``order``), without a window over the data: rows are range-partitioned
    and sorted, stored with their number inside the partition, and each
    partition's base is a prefix sum over one count per partition (and group)."""
    keys = [group] if group else []
    placed = stored(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                    .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
                    .withColumn("_row", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_row", 33)
    # one row per partition and group that meet: at most partitions + groups
    counts = (placed.groupBy(part.alias("_part"), *keys)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", *[F.col(k).alias("_group") for k in keys], "_first",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    on = part == F.col("_part")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("_group"))
    return (placed.join(F.broadcast(bases), on)
            .withColumn("pos", (F.col("_row") - F.col("_first") + F.col("_base")).cast("long"))
            .drop("_row", "_part", "_group", "_first", "_base", "_n"))
