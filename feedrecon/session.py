"""Session helpers: one place that builds a local session for tests/bench and
resolves the shared work folder from the session's own configuration."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "feedrecon") -> SparkSession:
    """A local session for tests and the bench. Production jobs receive the
    cluster's session instead and never call this."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FEEDRECON_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for written tables and lineage cuts.

    Uses ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder). Only when it is unset and the master is local (tests, bench) is a
    private folder created and registered, so a cluster never falls back to a
    machine-local path."""
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs that write")
    root = tempfile.mkdtemp(prefix="feedrecon-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused sub folder of the work root for one job run."""
    return f"{work_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, name: str) -> tuple:
    """The session's Hadoop file system for a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def glob_status(spark: SparkSession, pattern: str) -> list:
    """What the session's Hadoop file system has under a path or glob (an empty
    list if nothing); an unreachable or denied store raises."""
    fs, path = file_system(spark, pattern)
    found = fs.globStatus(path)
    return list(found) if found is not None else []


#: Bytecode a generated method may have in ``small_methods``. The JVM does not compile methods over 8,000 bytes at all and
#: compiles those near it badly.
METHOD_BYTES = "4000"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For a write whose projection is wide: stages with larger generated methods are run by projections made of
    small methods instead. The session's own setting is put back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, METHOD_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def at_once(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run independent writes side by side, so that one with few tasks does not hold up the others; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


#: Writes that ``at_once`` has under way.
WRITES_AT_ONCE = 16


def local_table(spark: SparkSession, rows: list, schema: str | StructType) -> DataFrame:
    """A few rows that are part of the plan: filters, projections and limits over them are worked out while planning,
    without a job. ``rows`` are tuples or Rows in the schema's order."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), kind)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table by its declared schema (partition columns included), also
    while it is empty or was never written."""
    if not glob_status(spark, path):
        return local_table(spark, [], schema)
    return spark.read.schema(schema).parquet(path)
