"""J11 — write canonical rows back out in a legacy layout.

The inverse of J2, one projection per layout: id prefix, the layout's date
pattern, its status vocabulary, its missing-value token, a combined name for
single-name layouts, and the layout's column order. No shuffle.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.layouts import Layout
from feedrecon.session import file_system, glob_status

CANONICAL_STATUSES = ("ACTIVE", "EXPIRED", "REVOKED", "PENDING")
UPDATED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def export_columns(lay: Layout, updated_at: Column) -> dict[str, Column]:
    """Source column name -> expression, for one layout."""
    vocab = F.create_map(*[F.lit(x) for pair in zip(CANONICAL_STATUSES, lay.status_vocab) for x in pair])
    cells: dict[str, Column] = {
        lay.student_id: F.concat(F.lit(lay.id_prefix), F.col("student_id")),
        lay.school_id: F.col("school_id"),
        lay.credential_type: F.col("credential_type"),
        lay.issue_date: F.date_format("issue_date", lay.date_pattern),
        lay.status: F.coalesce(F.try_element_at(vocab, F.col("status")), F.col("status")),
        lay.updated_at: F.date_format(updated_at, UPDATED_AT_PATTERN),
    }
    if lay.has_full_name:
        cells[lay.full_name] = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
    else:
        cells[lay.first_name] = F.col("first_name")
        cells[lay.last_name] = F.col("last_name")
    if lay.has_preferred:
        cells[lay.preferred_name] = F.coalesce(F.col("preferred_name"), F.lit(lay.missing_token))
    return cells


def export_layout(canonical: DataFrame, lay: Layout, updated_at: Column | None = None, *keep: str) -> DataFrame:
    """Canonical rows → the layout's columns, in its order, all text.
    ``updated_at`` defaults to the row's ``staged_at``."""
    ua = updated_at if updated_at is not None else F.col("staged_at")
    cells = export_columns(lay, ua)
    return canonical.select(*keep, *[cells[c].cast("string").alias(c) for c in lay.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-6: header line, RFC-4180 quoting with doubled quotes, every cell
    written (empty strings as empty fields)."""
    _writer(df).csv(path)


def _writer(df: DataFrame):
    return (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
            .option("emptyValue", "").option("nullValue", ""))


def write_csv_files(df: DataFrame, part: str, parts: str, folder: str, name: str = "") -> None:
    """One file per value of the column ``part`` (the rows of a value in one
    partition), renamed to ``<folder>/<name><value>.csv``: feeds with fixed names.
    A value may hold a folder (``s1/v1_0``). The driver renames one file per value: an export
    of a bounded number of named feeds; ``write_csv`` has no such loop."""
    _writer(df).partitionBy(part).csv(parts)
    spark = df.sparkSession
    for s in glob_status(spark, f"{parts}/{part}=*/*.csv"):
        value = unquote(s.getPath().getParent().getName().split("=", 1)[1])
        _rename(spark, s.getPath(), f"{folder}/{name}{value}.csv")


def move_files(spark: SparkSession, pattern: str, folder: str) -> None:
    """Move the files of a glob into a folder (files that arrive)."""
    for s in glob_status(spark, pattern):
        _rename(spark, s.getPath(), f"{folder}/{s.getPath().getName()}")


def _rename(spark: SparkSession, path, name: str) -> None:
    fs, to = file_system(spark, name)
    fs.mkdirs(to.getParent())
    fs.rename(path, to)
