"""J3 over Structured Streaming: new feed files → the same incremental ingest.

One stream for all layouts: its rows are **file names** (the file source lists new files and
remembers them in the stream's checkpoint; their content is not part of the stream). Each micro-batch
classifies its files by their real headers, as the batch job does, binds the columns by
name and routes every file to its layout; a file that fits none is an UNKNOWN row of the run's file table, and so is a file
whose name Spark's readers would skip.

``Trigger.AvailableNow`` processes whatever arrived since the
last run and stops — the nightly-batch shape. The source hands over each file once, so
every record of a new file is loaded, however old its update time; a
layout's watermark follows the newest update time loaded.

Each micro-batch calls ``run_ingest`` with ``run_id = <prefix>-<epoch>``:
a micro-batch replayed after a failure writes the same run's rows
again, so staging, quarantine, summaries and the control log stay exactly-once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedrecon.functions.rules import STATUS_WORDS
from feedrecon.layouts import LAYOUTS, Layout
from feedrecon.operators.classify import UNKNOWN
from feedrecon.operators.ingest import Tables, read_files, run_ingest
from feedrecon.session import glob_status
from feedrecon.sources import csv_feeds as CSV

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
NAME_PARTS = 2      # a feed is known by its folder and name here: what later batches bring can't be foreseen


def file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Names, lengths and times of change of new CSV files (``folder`` may be a glob of folders); contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def _hidden(spark: SparkSession, folder: str, target: Tables) -> DataFrame:
    """Files whose names Spark's readers skip and that no run has reported yet."""
    rows = [(s.getPath().toString(), s.getLen(), 1000 * s.getModificationTime())
            for s in glob_status(spark, f"{folder.rstrip('/')}/[._]*.csv") if s.isFile()]
    found = spark.createDataFrame(rows, "path string, length long, modified long").withColumn("path", CSV._same_scheme(F.col("path")))
    if not rows:
        return found
    return found.join(read_files(spark, target).where("schema_version IS NULL").select("path", "length", "modified"), found.columns, "left_anti")


def ingest_files(spark: SparkSession, files: DataFrame, target: Tables, run_ts: _dt.datetime, run_id: str, multi_line: bool = True,
                 layouts: dict[str, Layout] = LAYOUTS, status_words: dict[str, str] = STATUS_WORDS) -> DataFrame:
    """Load the given files (``path, length, modified, hidden``), each by the layout of its header; the run's summary."""
    listing = CSV.held(files.withColumn("path", CSV._same_scheme(F.col("path")))
                       .withColumn("feed", CSV.feed_name(F.col("path"), NAME_PARTS)), "arrived")
    classified = CSV.classify_files(listing, layouts)
    known = classified.where(F.col("version") != UNKNOWN)
    unknown = classified.where(F.col("version") == UNKNOWN).select(
        F.lit(None).cast("string").alias("schema_version"), F.col("feed").alias("file"),
        *[F.lit(0).cast("long").alias(c) for c in ("total_rows", "extracted_rows", "mapped_rows", "mapping_errors", "no_update_time_rows", "skipped_rows")],
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("max_updated_at", "newest")],
        "path", "length", "modified", F.lit(True).alias("opened"), "detection")
    return run_ingest(spark, CSV.read_classified(spark, classified, multi_line, layouts), target, run_ts, run_id, advance="max_updated_at",
                      watermark=False, layouts=layouts, status_words=status_words, carried=unknown,
                      files=known.select("feed", F.col("version").alias("ver"), "path", "length", "modified"))


def start_ingest_stream(spark: SparkSession, folder: str, target: Tables, checkpoint: str, run_prefix: str,
                        run_ts: Callable[[int], _dt.datetime] | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None, multi_line: bool = True, layouts: dict[str, Layout] = LAYOUTS,
                        status_words: dict[str, str] = STATUS_WORDS) -> StreamingQuery:
    """Start the stream over a folder that holds feeds of any layouts; with ``available_now`` it stops by itself once
    every file present at start has been ingested. Hidden names are reported by the next micro-batch."""
    clock = run_ts or (lambda epoch: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0))

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        files = batch.withColumn("hidden", F.lit(False)).unionByName(_hidden(session, folder, target).withColumn("hidden", F.lit(True)))
        ingest_files(session, files, target, clock(epoch_id), f"{run_prefix}-{epoch_id}", multi_line, layouts, status_words)

    writer = file_stream(spark, folder, max_files_per_trigger).writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
