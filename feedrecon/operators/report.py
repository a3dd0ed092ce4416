"""J10 — the reconciliation suite, overall status, gate and rendered report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.operators import checks as C
from feedrecon.operators.numbering import number_rows
from feedrecon.session import file_system, glob_status, new_work_dir

REPORT_WIDTH = 74
TITLE = "MIGRATION — RECONCILIATION REPORT"


class GateFailed(RuntimeError):
    """Raised by ``assert_gate`` when the suite's overall status is FAIL."""


def build_results(feed_counts: DataFrame, staging: DataFrame, tolerance_pct: float = C.DEFAULT_TOLERANCE_PCT,
                  thresholds=C.NULL_THRESHOLDS, allowed_types=C.ALLOWED_CREDENTIAL_TYPES,
                  allowed_statuses=C.ALLOWED_STATUSES) -> DataFrame:
    """CHK-12: all five check families in suite order, as one results frame.

    Four scans of ``staging``: row counts (the version column alone), all value
    checks together, duplicate groups, and the per-student profile. Nothing
    runs while the plan is built. Pass a staging table read from storage."""
    allowed = (("credential_type", allowed_types, "FAIL"), ("status", allowed_statuses, "WARNING"))
    return (C.reconcile_row_counts(feed_counts, staging, tolerance_pct)
            .unionByName(C.value_checks(staging, thresholds, allowed=allowed))
            .unionByName(C.check_exact_duplicates(staging))
            .unionByName(C.student_checks(staging))
            .select(*C.RESULT_COLUMNS))


def overall(results: DataFrame) -> DataFrame:
    """AGG-13: one row — ``overall_status, passed, warnings, failed, total``."""
    st = F.col("status")
    agg = results.agg(F.count_if(st == "PASS").alias("passed"), F.count_if(st == "WARNING").alias("warnings"),
                      F.count_if(st == "FAIL").alias("failed"), F.count(F.lit(1)).alias("total"))
    return agg.select(
        F.when(F.col("failed") > 0, F.lit("FAIL")).when(F.col("warnings") > 0, F.lit("PASS_WITH_WARNINGS"))
         .otherwise(F.lit("PASS")).alias("overall_status"),
        "passed", "warnings", "failed", "total")


def gate(results: DataFrame) -> DataFrame:
    """CHK-14 / DOC-5: the overall status with the process exit code
    (0 for PASS and PASS_WITH_WARNINGS, else 1) and whether the next layer may load."""
    o = overall(results)
    ok = F.col("overall_status").isin("PASS", "PASS_WITH_WARNINGS")
    return o.select("overall_status", F.when(ok, 0).otherwise(1).alias("exit_code"),
                    ok.alias("publish"))


def assert_gate(results: DataFrame) -> str:
    """Raise ``GateFailed`` when the suite failed; returns the overall status.
    Only the one-row aggregate reaches the driver."""
    row = gate(results).first()
    if row["exit_code"] != 0:
        raise GateFailed(f"reconciliation gate closed: {row['overall_status']}")
    return row["overall_status"]


def render(results: DataFrame, run_id: str, run_timestamp: str) -> DataFrame:
    """CHK-13: the report as ``line_no, line`` rows. Results have one row per file and check; their
    lines are built with column expressions and numbered by partition counts and prefix sums."""
    icon = F.when(F.col("status") == "PASS", "✓").when(F.col("status") == "FAIL", "✗") \
        .when(F.col("status") == "WARNING", "⚠").otherwise("?")
    # row counts in file-name order: the name in brackets, or all of it for an unknown file
    in_brackets = F.regexp_extract("check_name", r"^Row count: \S+ \((.*)\)$", 1)
    file = F.when(F.col("ordinal") == 1, F.when(in_brackets != "", in_brackets).otherwise(F.substring("check_name", 12, 1 << 30)))
    r = results.withColumn("file", file)
    keys = ["ordinal", "seq", "file", "check_name"]
    samples = F.slice("sample_values", 1, 5)
    lines = F.concat(
        F.array(F.format_string("  [%-7s] %s  %s", F.col("status"), icon, F.col("check_name")),
                F.concat(F.lit(" " * 13), F.col("detail"))),
        F.when(F.size(samples) > 0, F.array(F.concat(F.lit(" " * 13 + "Sample: ["), F.array_join(samples, ", "), F.lit("]"))))
         .otherwise(F.array().cast("array<string>")),
    )
    body = r.select(F.lit(1).alias("part"), *keys, F.posexplode(lines).alias("sub", "line"))
    # a family's head stands before its first result
    first = r.groupBy("check_type").agg(F.min(F.struct(*keys)).alias("k"))
    heads = first.select(F.lit(1).alias("part"), *[F.col(f"k.{c}").alias(c) for c in keys], F.posexplode(
        F.array(F.lit(""), F.col("check_type"), F.lit("-" * REPORT_WIDTH))).alias("sub", "line")).withColumn("sub", F.col("sub") - 3)
    bar = "=" * REPORT_WIDTH
    none = [F.lit(None).cast(body.schema[c].dataType).alias(c) for c in keys]
    top = results.sparkSession.createDataFrame(
        list(enumerate(["", bar, TITLE, f"Run timestamp  : {run_timestamp}", f"Pipeline run   : {run_id}", bar])), "sub int, line string"
    ).select(F.lit(0).alias("part"), *none, "sub", "line")
    tail = overall(results).select(F.lit(2).alias("part"), *none, F.posexplode(F.array(
        F.lit(""), F.lit(bar), F.concat(F.lit("OVERALL RESULT : "), F.col("overall_status")),
        F.concat(F.lit("  Passed   : "), F.col("passed").cast("string")),
        F.concat(F.lit("  Warnings : "), F.col("warnings").cast("string")),
        F.concat(F.lit("  Failed   : "), F.col("failed").cast("string")),
        F.lit(bar))).alias("sub", "line"))
    rows = top.unionByName(heads).unionByName(body).unionByName(tail)
    return number_rows(rows, ["part", *keys, "sub"], "line_no").select("line_no", "line")


def report_file(folder: str, ts) -> str:
    """The report's name in its folder, stamped with the given (local) time."""
    return f"{folder.rstrip('/')}/reconciliation_{ts:%Y%m%d_%H%M%S}.txt"


def save_report(lines: DataFrame, path: str) -> None:
    """SNK-7: write the rendered report as one UTF-8 text file ``path``. The
    lines are sorted in many tasks and concatenated by one, which is what one file takes."""
    spark = lines.sparkSession
    parts = new_work_dir(spark, "report")
    lines.orderBy("line_no").select("line").coalesce(1).write.text(parts)
    fs, to = file_system(spark, path)
    fs.mkdirs(to.getParent())
    (part,) = [s.getPath() for s in glob_status(spark, f"{parts}/part-*")]
    source, _ = file_system(spark, parts)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(source, part, fs, to, False, True, spark._jsc.hadoopConfiguration())


def suite_run_id(ts) -> str:
    """SCL-13: the suite's run id, ``sim_run_<UTC yyyymmdd_hhmmss>`` (a parameter, never read from a clock here)."""
    return f"sim_run_{ts:%Y%m%d_%H%M%S}"


def publish_if_passed(results: DataFrame, staging: DataFrame, path: str, version: str) -> str:
    """DOC-5: load the next layer only when the gate is open. The gate is a
    one-row aggregate; on FAIL nothing is written and ``GateFailed`` is raised. The rows are written
    as a version of their own, and only then the layer's pointer is switched to it, so a
    write that fails leaves the version before in place. A repeated call replaces its own version."""
    status = assert_gate(results)
    staging.write.mode("overwrite").parquet(f"{path}/versions/{version}")
    _point(staging.sparkSession, path, version)
    return status


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Pointers are files named by a rising number that hold a version; the highest whole one counts."""
    n = max(_pointers(spark, path), default=0) + 1
    fs, to = file_system(spark, f"{path}/current/{n:012d}")
    fs.mkdirs(to.getParent())
    temporary = file_system(spark, f"{path}/current/_{n:012d}-{version}")[1]
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    if not fs.rename(temporary, to):
        raise OSError(f"another publication of {path} took place at the same time")


def _pointers(spark: SparkSession, path: str) -> list[int]:
    return [int(s.getPath().getName()) for s in glob_status(spark, f"{path}/current/[0-9]*")]


def published_version(spark: SparkSession, path: str) -> str | None:
    """The version of a layer that counts, if any was published."""
    numbers = _pointers(spark, path)
    if not numbers:
        return None
    fs, name = file_system(spark, f"{path}/current/{max(numbers):012d}")
    with_version = fs.open(name)
    try:
        return bytes(with_version.readAllBytes()).decode()
    finally:
        with_version.close()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published rows of a layer."""
    version = published_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was published under {path}")
    return spark.read.parquet(f"{path}/versions/{version}")
