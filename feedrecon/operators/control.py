"""J3 — per-layout high-watermarks kept as an append-only event log.

The legacy control table is one mutable row per layout (upsert / delete).
Parquet has no MERGE, so every change is an event row appended under its run's
own folder (rewritten whole on a retry, hence idempotent), and the current
state is a ``max_by`` over the log: one small aggregation per read.

Events are ``advance`` and ``reset`` of a layout, and ``append`` or ``reload`` of
a whole run (its rows count from then on; a reload hides all earlier runs).
Order of events = (seq, step), with ``seq`` the run's place in the log, so equal or
turned-back clocks change nothing. A place is claimed by creating a file that must
not exist yet, so two runs started together get different places.

However many runs there were, a read opens a bounded number of files: the runs of a
block of ``BLOCK`` places share a folder, and at the end of a block the events that
still matter (per layout the last reset, the first advance after it and the
last event; one event a run) are written as a snapshot. A reader takes the
newest snapshot and the blocks after it. A lost snapshot only makes the tail longer.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedrecon.functions.rules import ntz
from feedrecon.layouts import VERSIONS
from feedrecon.session import file_system, glob_status, local_table

# ---------------------------------------------------------------------------
# FIXED VALUE — the watermark of a layout that has none (first run).
# ---------------------------------------------------------------------------
EPOCH = _dt.datetime(2000, 1, 1)

LOG_SCHEMA = ("schema_version string, event string, last_processed_at timestamp_ntz, "
              "last_run_row_count long, last_run_timestamp timestamp_ntz, logged_at timestamp_ntz, "
              "seq long, step int, run_id string")
#: Places of the log that share a folder; a snapshot is written after so many.
BLOCK = 64


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders ``<path>/<name>=<n>``."""
    return sorted(int(s.getPath().getName().split("=", 1)[1]) for s in glob_status(spark, f"{path}/{name}=*"))


def _snapshot(spark: SparkSession, path: str, before: int | None) -> int | None:
    """The newest finished snapshot of events up to a place before ``before``."""
    done = [int(s.getPath().getParent().getName().split("=", 1)[1]) for s in glob_status(spark, f"{path}/snapshots/seq=*/_SUCCESS")]
    return max((n for n in done if before is None or n < before), default=None)


def log_files(spark: SparkSession, path: str, before: int | None = None) -> list[str]:
    """The folders a reader of the log opens: one snapshot and the blocks after it."""
    last = _snapshot(spark, path, before)
    blocks = [b for b in _folders(spark, f"{path}/events", "block")
              if (last is None or b > last // BLOCK) and (before is None or b <= before // BLOCK)]
    return ([f"{path}/snapshots/seq={last}"] if last is not None else []) + [f"{path}/events/block={b}/run_id=*" for b in blocks]


def read_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The events that matter (those before a place, if asked for), or an empty
    frame of the log schema when nothing was written yet."""
    files = log_files(spark, path, before)
    if not files:
        return local_table(spark, [], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(*files)
    return log if before is None else log.where(F.col("seq") < before)


def run_seq(spark: SparkSession, path: str, run_id: str) -> int:
    """A run's place in the log: the one it has (a re-executed run), else the
    next that no other run has claimed."""
    log, done = read_log(spark, path), _snapshot(spark, path, None) or 0
    r = log.agg(F.min(F.when(F.col("run_id") == run_id, F.col("seq"))).alias("own"), F.max("seq").alias("last"),
                F.count_distinct(F.when(F.col("seq") > done, F.col("seq"))).alias("places")).first()
    if r.own is not None:
        return r.own
    last = r.last or 0
    if r.places < last - done:                  # places that were claimed, but whose runs have not finished
        there = {x.seq for x in log.where(F.col("seq") > done).select("seq").distinct().collect()}
        for seq in range(done + 1, last):
            if seq not in there and _claim(spark, _claim_name(path, seq), run_id) == run_id:
                return seq
    seq = last + 1
    while _claim(spark, _claim_name(path, seq), run_id) != run_id:
        seq += 1
    return seq


def _claim_name(path: str, seq: int) -> str:
    return f"{path}/claims/block={seq // BLOCK}/{seq}"


def _claim(spark: SparkSession, name: str, run_id: str) -> str:
    """Create a claim file unless it is there; whose it is."""
    fs, path = file_system(spark, name)
    try:
        out = fs.create(path, False)
    except Exception as e:  # noqa: BLE001 (any store's way to say that the file exists)
        if not fs.exists(path):
            raise e
        with_owner = fs.open(path)
        try:
            return bytes(with_owner.readAllBytes()).decode()
        finally:
            with_owner.close()
    try:
        out.write(bytearray(run_id.encode()))
    finally:
        out.close()
    return run_id


def as_seen_by(log: DataFrame, seq: int) -> DataFrame:
    """The log as the run at place ``seq`` must see it: the events of earlier
    runs. A re-executed run therefore reads the same watermarks as its first
    attempt and rewrites identical partitions (idempotent retries)."""
    return log.where(F.col("seq") < seq)


def visible_runs(log: DataFrame) -> DataFrame:
    """``run_id`` of the runs whose rows count: completed, and none before the last completed full reload."""
    runs = log.where(F.col("event").isin("append", "reload"))
    last = runs.agg(F.coalesce(F.max(F.when(F.col("event") == "reload", F.col("seq"))), F.lit(0)))
    return runs.where(F.col("seq") >= last.scalar()).select("run_id").distinct()


def current_state(log: DataFrame) -> DataFrame:
    """SRC-6: one row per layout with a live watermark, ordered by layout.
    A reset (tombstone) hides earlier advances; ``created_at`` is the first
    advance after the latest reset (an upsert keeps it, a delete resets it).
    The log holds a handful of events per layout and run."""
    g = _marked(log).groupBy("schema_version").agg(
        F.max_by(F.struct("event", "last_processed_at", "last_run_row_count", "last_run_timestamp"), _order()).alias("last"),
        F.min(F.when(F.col("live"), F.col("logged_at"))).alias("created_at"),
    )
    return (g.where(F.col("last.event") == "advance")
            .select("schema_version", "last.last_processed_at", "last.last_run_row_count", "last.last_run_timestamp",
                    "created_at")
            .orderBy("schema_version"))


def _order():
    return F.struct("seq", "step")


def _marked(log: DataFrame) -> DataFrame:
    """Events of layouts with ``live``: an advance that no later reset hides."""
    log = log.where(F.col("event").isin("advance", "reset"))
    last_reset = F.max(F.when(F.col("event") == "reset", _order())).over(Window.partitionBy("schema_version"))
    return log.withColumn("last_reset", last_reset).withColumn(
        "live", (F.col("event") == "advance") & (F.col("last_reset").isNull() | (_order() > F.col("last_reset"))))


def fold(log: DataFrame) -> DataFrame:
    """The events of a log that still matter: ``current_state``, ``visible_runs`` and
    places read from them are those of the whole log."""
    one = Window.partitionBy("schema_version", "kind")
    last = _marked(log).withColumn("kind", F.explode(F.array_compact(F.array(
        F.lit("last"), F.when(F.col("live"), F.lit("first")), F.when(F.col("event") == "reset", F.lit("reset"))))))
    first = F.when(F.col("kind") == "first", F.struct(F.col("logged_at"), "seq", "step"))
    kept = last.withColumn("rank", F.row_number().over(one.orderBy(first.asc(), F.desc("seq"), F.desc("step")))).where("rank = 1")
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    return (kept.select(*columns).distinct()
            .unionByName(log.where(F.col("event").isin("append", "reload")).select(*columns)))


def watermarks(state: DataFrame, epoch: _dt.datetime = EPOCH, versions=VERSIONS) -> DataFrame:
    """SCL-9/JON-3: ``ver, watermark`` for every known layout, the epoch where
    none is stored. At most one row per layout, so it is safe to broadcast."""
    spark = state.sparkSession
    known = spark.createDataFrame([(v,) for v in versions], "ver string")
    s = state.select(F.col("schema_version").alias("ver"), "last_processed_at")
    return known.join(s, "ver", "left").select(
        "ver", F.coalesce("last_processed_at", ntz(epoch)).alias("watermark"))


def advance_events(decisions: DataFrame, run_ts: _dt.datetime, run_id: str, seq: int) -> DataFrame:
    """ING-3/SNK-3: an ``advance`` event per layout whose run may move its
    watermark (no mapping errors, or at least one row mapped). ``decisions``
    has ``ver, mapped_rows, mapping_errors`` and optionally ``advance_to``
    (the new watermark; the run time when absent)."""
    ok = (F.col("mapping_errors") == 0) | (F.col("mapped_rows") > 0)
    ts = ntz(run_ts)
    to = F.col("advance_to") if "advance_to" in decisions.columns else ts
    return decisions.where(ok).select(
        F.col("ver").alias("schema_version"), F.lit("advance").alias("event"), to.alias("last_processed_at"),
        F.col("mapped_rows").cast("long").alias("last_run_row_count"), ts.alias("last_run_timestamp"),
        ts.alias("logged_at"), F.lit(seq).cast("long").alias("seq"), F.lit(1).alias("step"), F.lit(run_id).alias("run_id"))


def reset_events(spark: SparkSession, run_ts: _dt.datetime, run_id: str, seq: int, versions=None) -> DataFrame:
    """SNK-4: tombstones for one, several or all layouts."""
    vs = list(versions) if versions else list(VERSIONS)
    rows = [(v, "reset", None, None, None, run_ts, seq, 0, run_id) for v in vs]
    return local_table(spark, rows, LOG_SCHEMA)


def run_event(spark: SparkSession, run_ts: _dt.datetime, run_id: str, seq: int, reload: bool) -> DataFrame:
    """The run completed: its rows count, after a reload only its and later ones."""
    return local_table(spark, [(None, "reload" if reload else "append", None, None, None, run_ts, seq, 2, run_id)], LOG_SCHEMA)


def append_events(events: DataFrame, log_path: str, run_id: str, seq: int) -> None:
    """Write a run's events as one file under its own folder, so they appear
    together; a retried run replaces its own events only. The last run of a block
    adds the snapshot of everything up to it."""
    spark = events.sparkSession
    events.coalesce(1).write.mode("overwrite").parquet(f"{log_path}/events/block={seq // BLOCK}/run_id={run_id}")
    if seq % BLOCK == BLOCK - 1:
        write_snapshot(spark, log_path, seq)


def write_snapshot(spark: SparkSession, log_path: str, seq: int) -> bool:
    """Fold the log up to the end of a block, if every place since the last
    snapshot has its events: a run that is still under way could add to it."""
    last = _snapshot(spark, log_path, None) or 0
    if last >= seq:
        return False
    log = read_log(spark, log_path, seq + 1)
    if log.where(F.col("seq") > last).select("seq").distinct().count() < seq - last:
        return False
    fold(log).coalesce(1).write.mode("overwrite").parquet(f"{log_path}/snapshots/seq={seq}")
    return True


def reset(spark: SparkSession, log_path: str, run_ts: _dt.datetime, run_id: str, versions=None) -> None:
    seq = run_seq(spark, log_path, run_id)
    append_events(reset_events(spark, run_ts, run_id, seq, versions), log_path, run_id, seq)
