"""The two job entry points over a folder of legacy CSV feeds.

* ``ingest_directory`` (ING-1): classify every file by its header, read the
  recognised ones as text, run one incremental ingest into the target, and
  report the run totals (unknown files count as errors, as in the legacy run).
* ``reconcile_directory`` (CHK-12): the whole reconciliation suite — row
  counts per file (unknown files FAIL), null thresholds, integrity,
  duplicates, cross-version consistency — against the target's staging.

Layouts, status words, thresholds and allowed values are parameters (§2.12).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.functions.rules import STATUS_WORDS
from feedrecon.layouts import LAYOUTS, Layout
from feedrecon.operators import checks as C
from feedrecon.operators import ingest as IG
from feedrecon.operators import normalise as N
from feedrecon.operators import report as RP
from feedrecon.operators import suite_state as SS
from feedrecon.operators.classify import UNKNOWN
from feedrecon.sources import csv_feeds as CSV


def ingest_directory(spark: SparkSession, source_dir: str, target: IG.Tables, run_ts: _dt.datetime, run_id: str,
                     full_reload: bool = False, multi_line: bool = True, layouts: dict[str, Layout] = LAYOUTS,
                     status_words: dict[str, str] = STATUS_WORDS, advance: str = "run_ts") -> tuple[DataFrame, DataFrame]:
    """Returns (per-file run summary, run totals). A folder without (known)
    feeds loads nothing; a full reload of it empties staging. Files that are unchanged since the
    last run over files, and hold nothing newer than their layout's watermark, are not opened."""
    run = IG.begin_run(spark, target, run_id, full_reload, layouts)
    listing = CSV.list_files(spark, source_dir)
    decisions = CSV.held(IG.file_decisions(listing, IG.file_state(spark, target, run.seq), run.marks), "file-decisions")
    opened = CSV.classify_files(decisions.where("open").select(*[c.split()[0] for c in CSV.LISTED.split(", ")]), layouts)
    files = opened.where(F.col("version") != UNKNOWN).select("feed", F.col("version").alias("ver"), "path", "length", "modified")
    slots = CSV.read_classified(spark, opened, multi_line, layouts, source_dir)
    unread = opened.where(F.col("version") == UNKNOWN).select(
        F.lit(None).cast("string").alias("schema_version"), F.col("feed").alias("file"),
        *[F.lit(0).cast("long").alias(c) for c in IG.SUMMARY[2:]], *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("max_updated_at", "newest")],
        "path", "length", "modified", F.lit(True).alias("opened"), "detection")
    carried = IG.carried_rows(decisions).unionByName(unread)
    summary = IG.run_ingest(spark, slots, target, run_ts, run_id, full_reload=full_reload, advance=advance, files=files,
                            layouts=layouts, status_words=status_words, run=run, carried=carried)
    unknown = IG.read_files(spark, target).where((F.col("run_id") == run_id) & F.col("schema_version").isNull())
    return summary, IG.run_totals(summary, unknown)


def reconcile_directory(spark: SparkSession, source_dir: str, target: IG.Tables, tolerance_pct: float = 0.0,
                        multi_line: bool = True, layouts: dict[str, Layout] = LAYOUTS, thresholds=C.NULL_THRESHOLDS,
                        allowed_types=C.ALLOWED_CREDENTIAL_TYPES, allowed_statuses=C.ALLOWED_STATUSES) -> DataFrame:
    """The suite's results for a folder of feeds and the target's staging."""
    staging = IG.read_staging(spark, target).select(*N.CANONICAL)
    counts = CSV.feed_counts(spark, source_dir, multi_line=multi_line, layouts=layouts)
    return RP.build_results(counts, staging, tolerance_pct, thresholds=thresholds, allowed_types=allowed_types,
                            allowed_statuses=allowed_statuses)


def reconcile_kept(spark: SparkSession, target: IG.Tables, tolerance_pct: float = 0.0, options: SS.Options = SS.Options(),
                   compact: int = SS.COMPACT) -> DataFrame:
    """The suite after a nightly run of ``ingest_directory``: what the run added is aggregated into the kept state,
    and all results come from that state and the run's file table. Neither the feeds nor earlier staging is read."""
    SS.update(spark, target, options, compact)
    staging = IG.read_staging(spark, target).select(*N.CANONICAL)
    return SS.results(IG.known_counts(spark, target), SS.state(spark, target, options), staging, tolerance_pct, options)
