"""Incremental ingest: metamorphic and retry tests."""

import datetime as dt

from pyspark.sql import functions as F

from feedrecon.operators import control as CT
from feedrecon.operators import ingest as IG
from feedrecon.operators import normalise as N
from feedrecon.plans import scenarios as S
from feedrecon.session import new_work_dir


def _canon(df):
    return df.select(*N.CANONICAL)


def test_two_runs_over_disjoint_updates_equal_one_full_load(spark, sf_small):
    f = S.feeds(spark, sf_small).where(F.col("raw_updated_at") != "")   # rows with no update time repeat (P2)
    t1 = IG.Tables(new_work_dir(spark, "t-two"))
    IG.run_ingest(spark, S.delivery(f, S.RUN1_TS, include_late=True), t1, S.RUN1_TS, "r1")
    IG.run_ingest(spark, S.delivery(f, S.RUN2_TS, include_late=True), t1, S.RUN2_TS, "r2")
    t2 = IG.Tables(new_work_dir(spark, "t-one"))
    IG.run_ingest(spark, f, t2, S.RUN2_TS, "all")
    a, b = _canon(IG.read_staging(spark, t1)), _canon(IG.read_staging(spark, t2))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_rerun_of_same_run_changes_nothing(spark, sf_small):
    """P7: re-executing a run (after a crash or on purpose) rewrites exactly
    its own partitions; staging, quarantine and the control state are unchanged."""
    f = S.feeds(spark, sf_small)
    t = IG.Tables(new_work_dir(spark, "t-retry"))
    IG.run_ingest(spark, S.delivery(f, S.RUN1_TS, include_late=False), t, S.RUN1_TS, "r1")
    IG.run_ingest(spark, S.delivery(f, S.RUN2_TS, include_late=True), t, S.RUN2_TS, "r2")
    before = _canon(IG.read_staging(spark, t)).collect()
    state_before = CT.current_state(CT.read_log(spark, t.control)).collect()
    IG.run_ingest(spark, S.delivery(f, S.RUN2_TS, include_late=True), t, S.RUN2_TS, "r2")
    IG.run_ingest(spark, S.delivery(f, S.RUN1_TS, include_late=False), t, S.RUN1_TS, "r1")
    after = _canon(IG.read_staging(spark, t)).collect()
    assert sorted(map(repr, before)) == sorted(map(repr, after))
    assert CT.current_state(CT.read_log(spark, t.control)).collect() == state_before


def test_watermark_read_once_per_run_second_feed_same_version(spark, sf_small):
    """P5 fix: two files of one layout in one run are filtered by the same watermark."""
    f = S.feeds(spark, sf_small).where("ver = 'v3' AND (raw_updated_at = '' OR raw_updated_at > '2000-01-01')")   # none before the epoch
    split = f.withColumn("feed", F.when(F.col("k") % 16 == 2, F.lit("v3_a.csv")).otherwise(F.lit("v3_b.csv")))
    t = IG.Tables(new_work_dir(spark, "t-p5"))
    summ = IG.run_ingest(spark, split, t, S.RUN1_TS, "r1")
    rows = {r.file: r for r in summ.collect()}
    assert set(rows) == {"v3_a.csv", "v3_b.csv"}
    assert all(r.skipped_rows == 0 for r in rows.values())   # both read against the epoch


def test_reset_and_upsert_semantics(spark, sf_small):
    t = S.two_runs(spark, sf_small, reset_versions=("v3",))
    st = {r.schema_version: r for r in CT.current_state(CT.read_log(spark, t.control)).collect()}
    assert st["v3"].created_at == S.RUN2_TS and st["v1"].created_at == S.RUN1_TS
    assert all(r.last_processed_at == S.RUN2_TS for r in st.values())


def test_no_advance_when_every_row_fails(spark, sf_small):
    f = S.feeds(spark, sf_small).where("ver = 'v2' AND raw_updated_at <> '1999-12-31T00:00:00'").withColumn("raw_issue_date", F.lit("bad"))
    t = IG.Tables(new_work_dir(spark, "t-noadv"))
    IG.run_ingest(spark, f, t, S.RUN1_TS, "r1")
    assert CT.current_state(CT.read_log(spark, t.control)).count() == 0
    assert IG.read_quarantine(spark, t).count() == f.count()


def test_empty_delta_still_advances(spark, sf_small):
    f = S.feeds(spark, sf_small).where("ver = 'v4' AND raw_updated_at <> ''")
    t = IG.Tables(new_work_dir(spark, "t-empty"))
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r1")
    IG.run_ingest(spark, f, t, S.RUN2_TS + dt.timedelta(days=1), "r2")
    st = CT.current_state(CT.read_log(spark, t.control)).collect()
    assert [(r.schema_version, r.last_run_row_count) for r in st] == [("v4", 0)]


def test_advance_to_max_updated_at_keeps_late_records(spark, sf_small):
    """P3 option: with the watermark at the newest loaded update time instead
    of the run time, a record stamped before run 1's time but delivered only
    in run 2 is still loaded; with the legacy rule it is lost."""
    f = S.feeds(spark, sf_small).where("ver = 'v1'")
    d1 = S.delivery(f, S.RUN1_TS, include_late=False)
    d2 = S.delivery(f, S.RUN2_TS, include_late=True)
    late_early = d2.join(d1, ["k", "copy_no"], "left_anti").where(F.col("raw_updated_at") != "")
    results = {}
    for mode in ("run_ts", "max_updated_at"):
        t = IG.Tables(new_work_dir(spark, f"t-adv-{mode}"))
        run1_time = S.RUN1_TS + dt.timedelta(days=400)        # the run happens well after its data
        IG.run_ingest(spark, d1, t, run1_time, "r1", advance=mode)
        IG.run_ingest(spark, d2, t, S.RUN2_TS, "r2", advance=mode)
        results[mode] = IG.read_staging(spark, t).where("run_id = 'r2'").count()
    n_late = late_early.where(F.to_timestamp("raw_updated_at") <= F.lit(S.RUN1_TS + dt.timedelta(days=400))).count()
    assert n_late > 0
    assert results["max_updated_at"] - results["run_ts"] > 0


def test_failure_inside_a_full_reload_changes_nothing(spark, sf_small, monkeypatch):
    """The reload's rows are written, then the run dies before its events: the
    table still shows the runs before; the rerun replaces them once."""
    import pytest
    f = S.feeds(spark, sf_small)
    t = IG.Tables(new_work_dir(spark, "t-reload"))
    IG.run_ingest(spark, S.delivery(f, S.RUN1_TS, include_late=False), t, S.RUN1_TS, "r1")
    before, state = IG.read_staging(spark, t).count(), CT.current_state(CT.read_log(spark, t.control)).collect()
    with monkeypatch.context() as m:
        m.setattr(CT, "append_events", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            IG.run_ingest(spark, f, t, S.RUN2_TS, "r2", full_reload=True)
    assert IG.read_staging(spark, t).count() == before
    assert CT.current_state(CT.read_log(spark, t.control)).collect() == state
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r2", full_reload=True)
    one = IG.Tables(new_work_dir(spark, "t-reload-one"))
    IG.run_ingest(spark, f, one, S.RUN2_TS, "r2")
    a, b = _canon(IG.read_staging(spark, t)), _canon(IG.read_staging(spark, one))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert {r.run_id for r in IG.read_quarantine(spark, t).select("run_id").distinct().collect()} == {"r2"}


def test_two_runs_with_equal_run_time(spark, sf_small):
    """The second run sees the first one's watermark whatever the clock says."""
    f = S.feeds(spark, sf_small).where("raw_updated_at <> ''")
    t = IG.Tables(new_work_dir(spark, "t-clock"))
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r1")
    n = IG.read_staging(spark, t).count()
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r2")
    assert IG.read_staging(spark, t).count() == n
