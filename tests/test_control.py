"""The control log: places, snapshots, bounded reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedrecon.operators import control as CT

T0 = dt.datetime(2020, 1, 1)


def _run(spark, log, run_id, versions=("v1",), reload=False, reset=()):
    seq = CT.run_seq(spark, log, run_id)
    ts = T0 + dt.timedelta(days=seq)
    dec = spark.createDataFrame([(v, 5, 0) for v in versions], "ver string, mapped_rows long, mapping_errors long")
    events = CT.advance_events(dec, ts, run_id, seq).unionByName(CT.run_event(spark, ts, run_id, seq, reload))
    if reset:
        events = events.unionByName(CT.reset_events(spark, ts, run_id, seq, reset))
    CT.append_events(events, log, run_id, seq)
    return seq


def _seen(spark, log, before=None):
    log = CT.read_log(spark, log, before)
    return [tuple(r) for r in CT.current_state(log).collect()], sorted(r.run_id for r in CT.visible_runs(log).collect())


def test_snapshots_change_nothing(spark, tmp_dir, monkeypatch):
    """The same runs in a log with snapshots and in one without."""
    states = []
    for block in (4, 1000):
        monkeypatch.setattr(CT, "BLOCK", block)
        log, seen = f"{tmp_dir}/log{block}", []
        for i in range(14):
            if i == 6:
                CT.reset(spark, log, T0, "reset-v1", ("v1",))
            _run(spark, log, f"r{i:02}", ("v1", "v2") if i % 3 else ("v2",), reload=i == 9, reset=("v1", "v2") if i == 9 else ())
            seen.append(_seen(spark, log))
        # a run that is executed again keeps its place and sees what it saw
        assert CT.run_seq(spark, log, "r05") == 6
        seen += [_seen(spark, log, n) for n in (3, 7, 12)]
        states.append(seen)
    assert states[0] == states[1]
    monkeypatch.setattr(CT, "BLOCK", 4)
    assert CT._snapshot(spark, f"{tmp_dir}/log4", None) == 15 and len(CT.log_files(spark, f"{tmp_dir}/log4")) <= 2


def test_ten_thousand_runs_open_a_few_files(spark, tmp_dir):
    """A long log written block by block: a reader opens one snapshot and the tail, and no plan holds run ids."""
    log, n = f"{tmp_dir}/log", 10_000
    last = n - n % CT.BLOCK - 1
    day = F.make_interval(days=F.col("id").cast("int"))
    events = spark.range(1, last + 1).select(
        F.explode(F.array(F.lit("advance"), F.lit("append"))).alias("event"), (F.lit(T0).cast("timestamp_ntz") + day).alias("ts"), F.col("id").alias("seq"))
    adv = F.col("event") == "advance"
    rows = events.select(
        F.when(adv, F.concat(F.lit("v"), F.col("seq") % 8 + 1)).alias("schema_version"), "event", F.when(adv, F.col("ts")).alias("last_processed_at"),
        F.when(adv, F.col("seq")).alias("last_run_row_count"), F.when(adv, F.col("ts")).alias("last_run_timestamp"), F.col("ts").alias("logged_at"),
        "seq", F.when(adv, 1).otherwise(2).alias("step"), F.format_string("run-%05d", "seq").alias("run_id"))
    CT.fold(rows).coalesce(1).write.parquet(f"{log}/snapshots/seq={last}")
    for i in range(3):
        _run(spark, log, f"tail-{i}")
    files = CT.log_files(spark, log)
    assert len(files) == 2 and len(CT.read_log(spark, log).inputFiles()) == 4
    state, runs = _seen(spark, log)
    assert len(runs) == last + 3 and len(state) == 8
    from tests.plan_utils import plan_text
    assert "run-0" not in plan_text(CT.visible_runs(CT.read_log(spark, log)), "extended")


def test_two_runs_started_together_get_different_places(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    a, b = CT.run_seq(spark, log, "a"), CT.run_seq(spark, log, "b")
    assert (a, b) == (1, 2) and CT.run_seq(spark, log, "a") == 1        # a died before its events: it keeps its place
    _run(spark, log, "b")
    assert CT.run_seq(spark, log, "b") == 2 and CT.run_seq(spark, log, "c") == 3


def test_an_unfinished_place_holds_the_snapshot_back(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(CT, "BLOCK", 4)
    log = f"{tmp_dir}/log"
    assert CT.run_seq(spark, log, "slow") == 1
    for i in range(4):
        _run(spark, log, f"r{i}")
    assert CT._snapshot(spark, log, None) is None
    _run(spark, log, "slow", ("v5",))
    assert {r[0] for r in _seen(spark, log)[0]} == {"v1", "v5"}         # the late one is not lost
    for i in range(4, 8):
        _run(spark, log, f"r{i}")
    assert CT._snapshot(spark, log, None) == 7


def test_a_store_that_refuses_is_not_taken_for_a_claim(spark):
    with pytest.raises(Exception, match="nostore"):
        CT._claim(spark, "nostore://host/x", "r")


def test_many_runs_are_joined_not_listed(spark, sf_small, tmp_dir, monkeypatch):
    from feedrecon.operators import ingest as IG
    from feedrecon.plans import scenarios as S
    from tests.plan_utils import plan_text
    t, f = IG.Tables(f"{tmp_dir}/t"), S.feeds(spark, sf_small).where("k % 50 = 0")
    for i in range(2):
        IG.run_ingest(spark, f, t, S.RUN2_TS, f"some-run-{i}")
    IG.run_ingest(spark, f, t, S.RUN2_TS, "some-reload", full_reload=True)
    IG.run_ingest(spark, f, t, S.RUN2_TS, "some-run-3", watermark=False)
    few = sorted(map(repr, IG.read_staging(spark, t).collect()))
    monkeypatch.setattr(IG, "NAMED_RUNS", 1)
    many = IG.read_staging(spark, t)
    assert "some-run" not in plan_text(many, "extended").replace(tmp_dir, "") and sorted(map(repr, many.collect())) == few
    assert {r.run_id for r in many.select("run_id").distinct().collect()} == {"some-reload", "some-run-3"}
