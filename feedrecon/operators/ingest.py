"""J3 — incremental ingest: watermark filter → map → stage → advance.

One plan for all delivered feeds (slot form, ``feed`` + ``ver`` per record). The
source is scanned **once**: every record of an opened file is written in one
pass, under the run's own folder, as accepted, rejected or skipped (a skipped
one leaves no more than its feed and update time, so all counts come
from what was written). Staging and quarantine are views of that table over the
runs that count, so a re-run (after an executor loss or a driver retry) replaces
exactly its own rows, and a run that did not finish shows nothing.

The run's summary has one row per file with the file's length and time of change, its
newest update time and the number of records without one. The next run reads
it as a zone map: an unchanged file in which nothing is newer than the layout's
watermark is not opened (``file_decisions``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.functions import rules as R
from feedrecon.layouts import LAYOUTS, SLOTS, Layout
from feedrecon.operators import control as CT
from feedrecon.operators import normalise as N
from feedrecon.session import read_table, small_methods

LOADS_SCHEMA = ("student_id string, first_name string, last_name string, preferred_name string, school_id string, "
                "credential_type string, issue_date date, status string, source_schema_version string, "
                "source_student_id string, staged_at timestamp_ntz, feed string, updated_ts timestamp_ntz, "
                "reasons array<string>, " + ", ".join(f"{c} string" for c in SLOTS) + ", outcome string, run_id string")
SUMMARY_SCHEMA = ("schema_version string, file string, total_rows long, extracted_rows long, mapped_rows long, "
                  "mapping_errors long, no_update_time_rows long, skipped_rows long, max_updated_at timestamp_ntz, "
                  "newest timestamp_ntz, path string, length long, modified long, opened boolean, detection string, run_id string")
#: AGG-11: the columns of a run summary; the others describe the file for the next run.
SUMMARY = ("schema_version", "file", "total_rows", "extracted_rows", "mapped_rows", "mapping_errors",
           "no_update_time_rows", "skipped_rows")
ACCEPTED, REJECTED, SKIPPED = "accepted", "rejected", "skipped"
#: Files of a delivery that are to be opened: what the listing says of them.
FILES_SCHEMA = "feed string, ver string, path string, length long, modified long"


@dataclass(frozen=True)
class Tables:
    """Folder layout of one ingest target."""
    root: str

    @property
    def loads(self) -> str:
        """Rows of opened files, one folder per run; accepted (staging), rejected (quarantine) and skipped apart."""
        return f"{self.root}/loads"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    @property
    def summaries(self) -> str:
        return f"{self.root}/run_summary"


def _extracted(marks_col: str = "watermark"):
    u = R.lenient_updated_at(F.col("raw_updated_at"))
    return u.isNull() | (u > F.col(marks_col))


def incremental_extract(feed_df: DataFrame, marks: DataFrame) -> DataFrame:
    """FLT-1: records strictly newer than their layout's watermark, plus those
    whose update time is empty or unparseable. ``marks`` is ``ver, watermark``
    (one row per layout), broadcast: its size is bounded by the registry."""
    j = feed_df.join(F.broadcast(marks), "ver", "left")
    return j.where(_extracted()).drop("watermark")


def load_rows(flagged: DataFrame, run_ts: _dt.datetime, layouts: dict[str, Layout] = LAYOUTS,
              status_words: dict[str, str] = R.STATUS_WORDS) -> DataFrame:
    """The rows a run stores for records with ``extracted`` and ``updated_ts``: canonical columns of extracted ones, the
    reasons and raw cells of rejected ones (to replay them), the update time and ``outcome`` of all."""
    t = N.tag(flagged, "feed", "updated_ts", "extracted", *SLOTS, run_ts=run_ts, layouts=layouts, status_words=status_words)
    loaded, rejected = F.col("extracted"), F.col("extracted") & ~F.col("accepted")
    outcome = F.when(~loaded, SKIPPED).when(F.col("accepted"), ACCEPTED).otherwise(REJECTED)
    return t.select(*[F.when(loaded, F.col(c)).alias(c) for c in N.STAGING if c != "source_schema_version"], "source_schema_version",
                    "feed", "updated_ts", F.when(rejected, F.col("reasons")).alias("reasons"),
                    *[F.when(rejected, F.col(c)).alias(c) for c in SLOTS], outcome.alias("outcome"))


def summary_of(loaded: DataFrame, files: DataFrame | None = None, carried: DataFrame | None = None) -> DataFrame:
    """AGG-11: per delivered file — total, extracted, mapped, mapping errors,
    skipped (= total − extracted), and the records with no usable update time
    (re-extracted on every run, P2), all from what the run wrote. ``files`` (``FILES_SCHEMA``) lists every
    recognised file that was opened, so one without a record has its row too; ``carried`` are the rows of
    files that were not (``file_decisions``)."""
    n = [("total_rows", F.count(F.lit(1))), ("extracted_rows", F.count_if(F.col("outcome") != SKIPPED)),
         ("mapped_rows", F.count_if(F.col("outcome") == ACCEPTED)), ("mapping_errors", F.count_if(F.col("outcome") == REJECTED)),
         ("no_update_time_rows", F.count_if(F.col("updated_ts").isNull())), ("skipped_rows", F.count_if(F.col("outcome") == SKIPPED))]
    per = loaded.groupBy(F.col("feed").alias("file"), F.col("source_schema_version").alias("schema_version")).agg(
        *[c.alias(name) for name, c in n], F.max(F.when(F.col("outcome") == ACCEPTED, F.col("updated_ts"))).alias("max_updated_at"),
        F.max("updated_ts").alias("newest"))
    if files is None:
        none = loaded.sparkSession.createDataFrame([], FILES_SCHEMA).schema
        per = per.select("*", *[F.lit(None).cast(none[c].dataType).alias(c) for c in ("path", "length", "modified")])
    else:
        names = files.select(F.col("feed").alias("file"), F.col("ver").alias("schema_version"), "path", "length", "modified")
        per = names.join(per, ["file", "schema_version"], "left").withColumns({name: F.coalesce(name, F.lit(0)) for name, _ in n})
    rows = per.select("*", F.lit(True).alias("opened"), F.col("schema_version").alias("detection"))
    return rows if carried is None else rows.unionByName(carried)


def file_state(spark: SparkSession, target: Tables, seq: int) -> DataFrame:
    """The summary of the last finished run over files before a place in the log: per ``path`` what was known of it."""
    done = CT.read_log(spark, f"{target.control}", seq).where(F.col("event").isin("append", "reload")).orderBy(F.desc("seq")).limit(STATE_RUNS)
    for r in done.select("run_id").collect():
        rows = _of_run(spark, target.summaries, SUMMARY_SCHEMA, r.run_id).where("path IS NOT NULL")
        if not rows.isEmpty():
            return rows
    return read_table(spark, f"{target.summaries}/none", SUMMARY_SCHEMA)


#: How many runs back a run over files is looked for.
STATE_RUNS = 16


def file_decisions(listing: DataFrame, state: DataFrame, marks: dict[str, _dt.datetime]) -> DataFrame:
    """FLT-1 over files: every listed file (``path, feed, length, modified``) with ``reason``: ``new`` or
    ``changed`` (by length or time of change), ``no update time`` (holds records that every run extracts), ``newer`` (its
    newest update time is past its layout's watermark), ``unknown`` (its header fitted no layout; the registry may have
    grown) — these are opened (``open``) — or ``unchanged``: no record of it would be extracted. The state's
    columns come along. One row per file on both sides."""
    known = [c.split()[0] for c in SUMMARY_SCHEMA.split(", ") if c.split()[0] not in ("path", "length", "modified", "run_id", "file")]
    was = state.select(F.col("path").alias("was_path"), F.col("length").alias("was_length"), F.col("modified").alias("was_modified"), *known)
    mark = F.lit(None).cast("timestamp_ntz")
    for v, ts in marks.items():
        mark = F.when(F.col("schema_version") == v, R.ntz(ts)).otherwise(mark)
    j = listing.join(was, F.col("path") == F.col("was_path"), "left").withColumn("mark", mark)
    reason = (F.when(F.col("was_path").isNull(), "new")
              .when((F.col("length") != F.col("was_length")) | (F.col("modified") != F.col("was_modified")), "changed")
              .when(F.col("mark").isNull(), "unknown")                  # no layout, or one that is no longer registered
              .when(F.col("no_update_time_rows") > 0, "no update time")
              .when(F.col("newest") > F.col("mark"), "newer").otherwise("unchanged"))
    return j.withColumn("reason", reason).withColumn("open", F.col("reason") != "unchanged").drop("was_path", "was_length", "was_modified", "mark")


def carried_rows(decisions: DataFrame) -> DataFrame:
    """Summary rows of the files that are not opened: all their records are skipped."""
    zero = F.lit(0).cast("long")
    return decisions.where(~F.col("open")).select(
        "schema_version", F.col("feed").alias("file"), "total_rows", zero.alias("extracted_rows"), zero.alias("mapped_rows"),
        zero.alias("mapping_errors"), "no_update_time_rows", F.col("total_rows").alias("skipped_rows"),
        F.lit(None).cast("timestamp_ntz").alias("max_updated_at"), "newest", "path", "length", "modified",
        F.lit(False).alias("opened"), "detection")


def run_totals(summary: DataFrame, unknown_feeds: int | DataFrame = 0) -> DataFrame:
    """AGG-12/ING-4: staged, skipped, errors (mapping errors + unknown feeds), status."""
    s = summary.agg(F.coalesce(F.sum("mapped_rows"), F.lit(0)).cast("long").alias("staged"),
                    F.coalesce(F.sum("skipped_rows"), F.lit(0)).cast("long").alias("skipped"),
                    F.coalesce(F.sum("mapping_errors"), F.lit(0)).cast("long").alias("mapping_errors"))
    if isinstance(unknown_feeds, DataFrame):
        u = unknown_feeds.agg(F.count(F.lit(1)).alias("unknown_feeds"))
        s = s.unionByName(u, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in ("staged", "skipped", "mapping_errors")],
            F.coalesce(F.max("unknown_feeds"), F.lit(0)).alias("unknown_feeds"))
    else:
        s = s.withColumn("unknown_feeds", F.lit(int(unknown_feeds)).cast("long"))
    errors = F.col("mapping_errors") + F.col("unknown_feeds")
    return s.select("staged", "skipped", errors.alias("errors"),
                    F.when(errors == 0, F.lit("COMPLETED")).otherwise(F.lit("COMPLETED WITH WARNINGS")).alias("status"))


@dataclass(frozen=True)
class Run:
    """A run's place in the log and the watermarks it reads against, one per layout."""
    seq: int
    marks: dict[str, _dt.datetime]


def begin_run(spark: SparkSession, target: Tables, run_id: str, full_reload: bool = False, layouts: dict[str, Layout] = LAYOUTS) -> Run:
    """Claim the run's place and read the watermarks of the runs before it (P5: once per run; a re-executed run
    sees what its first attempt saw; a full reload reads against the epoch)."""
    seq = CT.run_seq(spark, target.control, run_id)
    stored = {} if full_reload else {r.schema_version: r.last_processed_at
                                     for r in CT.current_state(CT.read_log(spark, target.control, seq)).collect()}      # one row per layout
    return Run(seq, {v: stored.get(v) or CT.EPOCH for v in layouts})


def _watermark(marks: dict[str, _dt.datetime]):
    out = None
    for v, ts in marks.items():
        out = F.when(F.col("ver") == v, R.ntz(ts)) if out is None else out.when(F.col("ver") == v, R.ntz(ts))
    return out


def run_ingest(spark: SparkSession, feed_df: DataFrame, target: Tables, run_ts: _dt.datetime, run_id: str,
               full_reload: bool = False, advance: str = "run_ts", files: DataFrame | None = None,
               watermark: bool = True, layouts: dict[str, Layout] = LAYOUTS,
               status_words: dict[str, str] = R.STATUS_WORDS, run: Run | None = None, carried: DataFrame | None = None) -> DataFrame:
    """ING-1/ING-2: one incremental run over all delivered feeds. Returns the
    run summary read back from storage (one row per feed).

    Order: place and watermarks (``begin_run``) → every record of the source written once, under the
    run's own folder, accepted, rejected and skipped apart → the summary, from what was
    written → last, in one file, the run's events: resets (full reload), advances, and the event that makes its rows count.
    Until then the table shows the runs before, whatever failed on the way.

    ``full_reload`` reads against the epoch and hides every earlier run.
    ``watermark=False`` loads every record (a stream whose source already hands over each file once).
    ``advance="run_ts"`` (legacy) moves a layout's watermark to the run time;
    ``advance="max_updated_at"`` moves it to the newest update time among the
    run's mapped records (never backwards), so a record stamped before the
    run but delivered after it is not lost (P3). ``files`` lists the recognised files that are
    opened, so that one without a record is summarised and advances; ``carried`` are the summary rows of those that are not."""
    if advance not in ("run_ts", "max_updated_at"):
        raise ValueError(f"advance must be 'run_ts' or 'max_updated_at', not {advance!r}")
    run = run or begin_run(spark, target, run_id, full_reload, layouts)
    updated = R.lenient_updated_at(F.col("raw_updated_at"))
    newer = F.col("updated_ts").isNull() | (F.col("updated_ts") > _watermark(run.marks))
    flagged = feed_df.withColumn("updated_ts", updated).withColumn("extracted", F.coalesce(newer, F.lit(False)) if watermark else F.lit(True))
    # static: a run executed again over a source that has changed leaves nothing of its first attempt
    with small_methods(spark):
        (load_rows(flagged, run_ts, layouts, status_words).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("outcome", "source_schema_version").parquet(f"{target.loads}/run_id={run_id}"))
    loaded = _of_run(spark, target.loads, LOADS_SCHEMA, run_id)
    (summary_of(loaded, files, carried).drop("run_id").coalesce(SUMMARY_FILES)
     .write.mode("overwrite").parquet(f"{target.summaries}/run_id={run_id}"))
    summary = _of_run(spark, target.summaries, SUMMARY_SCHEMA, run_id).where("schema_version IS NOT NULL")
    decisions = summary.groupBy(F.col("schema_version").alias("ver")).agg(
        F.sum("mapped_rows").alias("mapped_rows"), F.sum("mapping_errors").alias("mapping_errors"),
        F.max("max_updated_at").alias("max_updated_at"))
    if advance == "max_updated_at":
        mark = _watermark(run.marks)
        decisions = decisions.withColumn("advance_to", F.coalesce(F.greatest("max_updated_at", mark), mark))
    events = CT.advance_events(decisions, run_ts, run_id, run.seq).unionByName(CT.run_event(spark, run_ts, run_id, run.seq, full_reload))
    if full_reload:
        events = events.unionByName(CT.reset_events(spark, run_ts, run_id, run.seq, list(layouts)))
    CT.append_events(events, target.control, run_id, run.seq)
    return summary.select(*SUMMARY)


#: Files a run's summary is written to (one row per delivered file).
SUMMARY_FILES = 4


def _of_run(spark: SparkSession, root: str, schema: str, run_id: str) -> DataFrame:
    """One run's rows of a table, without listing the other runs."""
    return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/run_id={run_id}")


def run_rows(spark: SparkSession, target: Tables, run_id: str) -> DataFrame:
    """Every row one run stored, whether it counts or not."""
    return _of_run(spark, target.loads, LOADS_SCHEMA, run_id)


def known_counts(spark: SparkSession, target: Tables) -> DataFrame:
    """CHK-1 input without a scan of the feeds: records of every file as the last finished run over files knew them
    (``feed, ver, source_count``; files no layout fits have no count)."""
    rows = file_state(spark, target, 1 << 62)
    return rows.select(F.col("file").alias("feed"), F.col("schema_version").alias("ver"), F.col("total_rows").alias("source_count"))


def read_loads(spark: SparkSession, target: Tables) -> DataFrame:
    """Every stored row, of unfinished and hidden runs too."""
    return read_table(spark, target.loads, LOADS_SCHEMA)


def read_summaries(spark: SparkSession, target: Tables) -> DataFrame:
    """AGG-11 of every run: the summary columns, the newest mapped update time, ``run_id``."""
    return read_table(spark, target.summaries, SUMMARY_SCHEMA).where("schema_version IS NOT NULL").select(*SUMMARY, "max_updated_at", "run_id")


def read_files(spark: SparkSession, target: Tables) -> DataFrame:
    """What every run knew of every file of its folder, opened or not, recognised or not."""
    return read_table(spark, target.summaries, SUMMARY_SCHEMA)


#: Runs up to which their folders are named in the plan (so that no other run's files are listed or read).
NAMED_RUNS = 64


def _visible(spark: SparkSession, target: Tables) -> DataFrame:
    """Rows of the runs that count: a few runs by name, many by a semi-join with the log."""
    runs = CT.visible_runs(CT.read_log(spark, target.control))
    named = [r.run_id for r in runs.limit(NAMED_RUNS + 1).collect()]
    if len(named) <= NAMED_RUNS:
        return read_loads(spark, target).where(F.col("run_id").isin(named) if named else F.lit(False))
    return read_loads(spark, target).join(F.broadcast(runs), "run_id", "left_semi")       # one short text a run


def read_staging(spark: SparkSession, target: Tables) -> DataFrame:
    """SNK-5: the accepted rows of the runs that count."""
    return _visible(spark, target).where(F.col("outcome") == ACCEPTED).select(*N.STAGING, "run_id")


def read_quarantine(spark: SparkSession, target: Tables) -> DataFrame:
    """The rejected rows of the runs that count, with every broken rule, the
    first one, and their raw cells as delivered."""
    return (_visible(spark, target).where(F.col("outcome") == REJECTED)
            .select(*N.STAGING, "feed", "reasons", F.element_at("reasons", 1).alias("reason"), *SLOTS, "run_id"))
