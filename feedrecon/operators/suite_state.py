"""J10 from kept partial aggregates: a nightly suite that reads what was added.

Every check of the suite is a function of five small-or-narrower tables: staged rows per layout,
counted facts of the values, rows per duplicate key, hash bounds per student, and the distinct values
of the profiled columns. All of them merge (sums, minima and maxima, distinct), so
each run's share is aggregated once, from that run's rows only, and kept:

    <root>/suite/<options>/run_id=<run>/<table>     a run's share
    <root>/suite/<options>/base=<n>/<table>         shares merged, with the list of runs in them

``update`` adds the shares of runs that have none and merges them into a new base after ``COMPACT``
of them. A base counts while all its runs do: after a full reload the shares of the runs that still count are
merged instead. A table of shares is written before the marker that makes it count, so a failure in between is only
work to repeat. Options (thresholds, allowed values) are part of the folder's name: other options are
another state.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.operators import checks as C
from feedrecon.operators import control as CT
from feedrecon.operators import ingest as IG
from feedrecon.operators import normalise as N
from feedrecon.session import glob_status, read_table

TABLES = ("counts", "facts", "groups", "students", "values")
#: Shares kept apart before they are merged into a base.
COMPACT = 16


@dataclass(frozen=True)
class Options:
    """The suite's parameters that its aggregates depend on."""
    thresholds: tuple = C.NULL_THRESHOLDS
    allowed_types: tuple = C.ALLOWED_CREDENTIAL_TYPES
    allowed_statuses: tuple = C.ALLOWED_STATUSES
    bits: int = C.HASH_BITS

    @property
    def allowed(self) -> tuple:
        return (("credential_type", self.allowed_types, "FAIL"), ("status", self.allowed_statuses, "WARNING"))

    @property
    def key(self) -> str:
        return f"{zlib.crc32(repr(self).encode()):08x}"


def shares(staging: DataFrame, options: Options = Options()) -> dict[str, DataFrame]:
    """The mergeable aggregates of staged rows."""
    profiled = staging.select("student_id", "school_id", "source_schema_version", "credential_type")
    return {
        "counts": staging.groupBy("source_schema_version").agg(F.count(F.lit(1)).alias("cnt")),
        "facts": C.value_facts(staging, options.thresholds, allowed=options.allowed),
        "groups": staging.groupBy(*C.DUPLICATE_KEYS).agg(F.count(F.lit(1)).alias("cnt")),
        "students": C.student_hashes(profiled, bits=options.bits),
        "values": C.profile_values(profiled),
    }


def merge(table: str, rows: DataFrame) -> DataFrame:
    """Shares of one table put together."""
    if table == "values":
        return rows.distinct()
    if table == "students":
        bounds = [c for c in rows.columns if c.startswith(("min_", "max_"))]
        return rows.groupBy("student_id").agg(*[(F.min if c.startswith("min_") else F.max)(c).alias(c) for c in bounds])
    return rows.groupBy(*[c for c in rows.columns if c != "cnt"]).agg(F.sum("cnt").alias("cnt"))


def _root(target: IG.Tables, options: Options) -> str:
    return f"{target.root}/suite/{options.key}"


def _share_runs(spark: SparkSession, root: str) -> list[str]:
    return [s.getPath().getParent().getParent().getName().split("=", 1)[1] for s in glob_status(spark, f"{root}/run_id=*/{TABLES[-1]}/_SUCCESS")]


def _bases(spark: SparkSession, root: str) -> list[int]:
    """Finished bases, newest first (their list of runs is written last)."""
    return sorted((int(s.getPath().getParent().getParent().getName().split("=", 1)[1])
                   for s in glob_status(spark, f"{root}/base=*/runs/_SUCCESS")), reverse=True)


def _visible(spark: SparkSession, target: IG.Tables) -> DataFrame:
    return CT.visible_runs(CT.read_log(spark, target.control))


def _base(spark: SparkSession, target: IG.Tables, root: str) -> tuple[int | None, DataFrame]:
    """The newest base all of whose runs count, and its runs."""
    none = spark.createDataFrame([], "run_id string")
    for n in _bases(spark, root):
        runs = read_table(spark, f"{root}/base={n}/runs", "run_id string")
        if runs.join(_visible(spark, target), "run_id", "left_anti").isEmpty():
            return n, runs
    return None, none


def _write(tables: dict[str, DataFrame], folder: str) -> None:
    for name in TABLES:
        tables[name].write.mode("overwrite").parquet(f"{folder}/{name}")


def update(spark: SparkSession, target: IG.Tables, options: Options = Options(), compact: int = COMPACT) -> None:
    """Aggregate the runs that count and have no share yet, each from its own rows; merge shares once there are enough."""
    root = _root(target, options)
    n, merged = _base(spark, target, root)
    have = set(_share_runs(spark, root))
    todo = [r.run_id for r in _visible(spark, target).join(merged, "run_id", "left_anti").orderBy("run_id").collect()]     # the tail only
    for run_id in todo:
        if run_id not in have:
            rows = IG.run_rows(spark, target, run_id).where(F.col("outcome") == IG.ACCEPTED).select(*N.CANONICAL)
            _write(shares(rows, options), f"{root}/run_id={run_id}")
    if len(todo) >= compact:
        folder = f"{root}/base={(_bases(spark, root) or [0])[0] + 1}"
        _write(state(spark, target, options), folder)
        _visible(spark, target).coalesce(1).write.mode("overwrite").parquet(f"{folder}/runs")


def state(spark: SparkSession, target: IG.Tables, options: Options = Options()) -> dict[str, DataFrame]:
    """The merged aggregates of all runs that count: the base and the shares after it. ``update`` first."""
    root = _root(target, options)
    n, merged = _base(spark, target, root)
    tail = [r.run_id for r in _visible(spark, target).join(merged, "run_id", "left_anti").collect()]
    missing = set(tail) - set(_share_runs(spark, root))
    if missing:
        raise ValueError(f"runs without their share of the suite's state, update it first: {sorted(missing)[:5]}")
    folders = ([f"{root}/base={n}"] if n is not None else []) + [f"{root}/run_id={r}" for r in tail]
    empty = shares(spark.createDataFrame([], ", ".join(f"{c} {'date' if c == 'issue_date' else 'string'}" for c in N.CANONICAL)), options)
    out = {}
    for name in TABLES:
        rows = spark.read.schema(empty[name].schema).parquet(*[f"{f}/{name}" for f in folders]) if folders else empty[name]
        out[name] = merge(name, rows)
    return out


def results(feed_counts: DataFrame, kept: dict[str, DataFrame], staging: DataFrame, tolerance_pct: float = C.DEFAULT_TOLERANCE_PCT,
            options: Options = Options()) -> DataFrame:
    """CHK-12 from kept aggregates: the rows of ``report.build_results``. ``staging`` is read only if two values of
    a profiled column share a hash."""
    if C.colliding_values(kept["values"], options.bits).isEmpty():
        profile = C.hash_flags(kept["students"])
    else:
        profile = C.student_profile(staging.select("student_id", "school_id", "source_schema_version", "credential_type"), bits=options.bits)
    return (C.row_count_results(feed_counts, kept["counts"], tolerance_pct)
            .unionByName(C.value_results(kept["facts"], options.thresholds, allowed=options.allowed))
            .unionByName(C.duplicate_results(kept["groups"].where("cnt > 1")))
            .unionByName(C.student_results(profile))
            .select(*C.RESULT_COLUMNS))
