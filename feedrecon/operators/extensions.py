"""J12 — capabilities the legacy documentation describes but its code lacks.

* DOC-1 ``orphan_schools``: staged school ids missing from a school dimension.
* DOC-2 ``cross_version_dates``: students in several layouts whose issue
  dates disagree (same single aggregation per student as J8/J9).
* DOC-3 ``dedupe_exact``: keep one row per exact-duplicate key. An aggregate
  picking the smallest row per key (``min`` of a struct) has a map-side
  partial step, so a key holding a third of all rows is reduced in every task
  before the shuffle, unlike a window that sorts the whole key in one task.
* DOC-4 ``row_counts_total``: per-layout counts with a TOTAL line (rollup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrecon.operators.checks import DUPLICATE_KEYS, student_profile

SCHOOLS_PER_DISTRICT = 30


def school_dimension(nation: DataFrame) -> DataFrame:
    """Known schools: every district (one per nation key) has schools
    SCH000 … SCH029 — ``DIST<nnn>-SCH<nnn>``. Size = districts x 30."""
    n = F.explode(F.sequence(F.lit(0), F.lit(SCHOOLS_PER_DISTRICT - 1))).alias("s")
    return nation.select(F.col("n_nationkey").alias("d"), n).select(
        F.concat(F.lit("DIST"), F.lpad(F.col("d").cast("string"), 3, "0"), F.lit("-SCH"),
                 F.lpad(F.col("s").cast("string"), 3, "0")).alias("school_id"))


def orphan_schools(staging: DataFrame, schools: DataFrame) -> DataFrame:
    """``school_id, rows, students`` for staged schools absent from the
    dimension (anti join; Catalyst/AQE broadcasts the dimension only when its
    measured size is under the threshold)."""
    o = staging.join(schools, "school_id", "left_anti")
    return o.groupBy("school_id").agg(F.count(F.lit(1)).alias("rows"),
                                      F.count_distinct("student_id").alias("students"))


def cross_version_dates(staging: DataFrame) -> DataFrame:
    p = student_profile(staging)
    return p.where("multi_version AND multi_date").select("student_id")


DEDUPE_ORDER = ("source_schema_version", "source_student_id", "first_name", "last_name", "preferred_name", "status")


def dedupe_exact(staging: DataFrame, keys=DUPLICATE_KEYS, order=DEDUPE_ORDER) -> DataFrame:
    """One row per key: the smallest by ``order`` (NULLs first), deterministic."""
    rest = [c for c in staging.columns if c not in keys and c not in order]
    pick = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("r")
    return staging.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"r.{c}").alias(c) for c in list(order) + rest]) \
        .select(*staging.columns)


def row_counts_total(feed_counts: DataFrame, staging: DataFrame) -> DataFrame:
    """``schema_version`` (or TOTAL), ``source_count``, ``staged_count``, ``delta``."""
    src = feed_counts.where(F.col("ver").isNotNull()).groupBy("ver").agg(F.sum("source_count").alias("source_count"))
    stg = staging.groupBy(F.col("source_schema_version").alias("ver")).agg(F.count(F.lit(1)).alias("staged_count"))
    j = src.join(stg, "ver", "full").select("ver", F.coalesce("source_count", F.lit(0)).alias("source_count"),
                                             F.coalesce("staged_count", F.lit(0)).alias("staged_count"))
    r = j.rollup("ver").agg(F.sum("source_count").alias("source_count"), F.sum("staged_count").alias("staged_count"),
                            F.grouping("ver").alias("g"))
    return r.select(F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col("ver")).alias("schema_version"),
                    F.col("source_count").cast("long").alias("source_count"),
                    F.col("staged_count").cast("long").alias("staged_count"),
                    (F.col("staged_count") - F.col("source_count")).cast("long").alias("delta"))


RECORD_KEY = ("source_schema_version", "source_student_id")


def latest_per_key(staging: DataFrame, keys=RECORD_KEY, newest_first=("staged_at", "run_id")) -> DataFrame:
    """P6 option: staging stays append-only; this view keeps each key's newest
    row (by ``newest_first``, then the remaining columns, so the choice is
    deterministic). ``max`` of a struct per key has a map-side partial step,
    so a hot key is reduced in every task before the shuffle."""
    rest = [c for c in staging.columns if c not in keys and c not in newest_first]
    order = [c for c in newest_first if c in staging.columns] + rest
    pick = F.max(F.struct(*[F.col(c) for c in order])).alias("r")
    return staging.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"r.{c}").alias(c) for c in order]) \
        .select(*staging.columns)
