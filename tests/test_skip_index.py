"""FLT-1 over files: unchanged files in which nothing is newer are not opened."""

import datetime as dt
import os
import time

import pytest

from feedrecon.operators import ingest as IG
from feedrecon.plans import scenarios as S
from feedrecon.plans.jobs import ingest_directory, reconcile_directory
from feedrecon.sources import csv_feeds as CSV
from tests.plan_utils import plan_text

V3 = "stu_id,firstName,lastName,school_code,credential_category,issued_on,status_code,modified_timestamp\n"
DAY = dt.timedelta(days=1)


def _write(d, name, *rows, text=None):
    os.makedirs(d, exist_ok=True)
    body = text if text is not None else V3 + "".join(f"stu{i},Ed,Ng,S1,GED,2020-01-02,ACT,{u}\n" for i, u in rows)
    with open(f"{d}/{name}", "w") as f:
        f.write(body)


@pytest.fixture()
def folder(tmp_path):
    d = f"{tmp_path}/in"
    _write(d, "old.csv", (1, "2020-01-01T00:00:00"), (2, "2020-06-01T00:00:00"))
    _write(d, "new.csv", (3, "2020-01-01T00:00:00"), (4, "2023-01-01T00:00:00"))
    _write(d, "none.csv", (5, ""), (6, "2020-01-01T00:00:00"))
    _write(d, "empty_v3.csv")
    _write(d, "bad.csv", text="x,y\n1,2\n")
    return d


def _run(spark, d, target, ts, run_id, **options):
    summary, totals = ingest_directory(spark, f"file:{d}", target, ts, run_id, **options)
    opened = {r.file: r.opened for r in IG.read_files(spark, target).where(f"run_id = '{run_id}'").collect()}
    return {r.file: (r.total_rows, r.extracted_rows, r.mapped_rows, r.skipped_rows) for r in summary.collect()}, opened, totals.first()


def test_second_run_opens_only_what_may_hold_news(spark, folder, tmp_path):
    t = IG.Tables(f"file:{tmp_path}/t")
    ts = dt.datetime(2022, 1, 1)
    rows, opened, totals = _run(spark, folder, t, ts, "r1")
    assert rows == {"old.csv": (2, 2, 2, 0), "new.csv": (2, 2, 2, 0), "none.csv": (2, 2, 2, 0), "empty_v3.csv": (0, 0, 0, 0)}
    assert all(opened.values()) and totals.errors == 1
    rows, opened, totals = _run(spark, folder, t, ts + DAY, "r2")
    assert rows == {"old.csv": (2, 0, 0, 2), "new.csv": (2, 1, 1, 1), "none.csv": (2, 1, 1, 1), "empty_v3.csv": (0, 0, 0, 0)}
    assert opened == {"old.csv": False, "new.csv": True, "none.csv": True, "empty_v3.csv": False, "bad.csv": True}
    assert (totals.staged, totals.skipped, totals.errors) == (2, 4, 1)
    # the same counts without any state: every file opened
    fresh = IG.Tables(f"file:{tmp_path}/fresh")
    _run(spark, folder, fresh, ts, "r1")
    slots, _ = CSV.read_feeds(spark, f"file:{folder}")
    plain = {r.file: (r.total_rows, r.extracted_rows, r.mapped_rows, r.skipped_rows)
             for r in IG.run_ingest(spark, slots, fresh, ts + DAY, "r2").collect()}
    assert plain == {k: v for k, v in rows.items() if k != "empty_v3.csv"}
    assert IG.read_staging(spark, t).count() == IG.read_staging(spark, fresh).count()


def test_changed_new_and_removed_files(spark, folder, tmp_path):
    t = IG.Tables(f"file:{tmp_path}/t")
    ts = dt.datetime(2022, 1, 1)
    _run(spark, folder, t, ts, "r1")
    time.sleep(0.05)
    _write(folder, "old.csv", (1, "2020-01-01T00:00:00"), (2, "2022-01-02T00:00:00"))      # same length, later time of change
    _write(folder, "more.csv", (9, "2022-01-01T12:00:00"))
    os.remove(f"{folder}/new.csv")
    rows, opened, _ = _run(spark, folder, t, ts + 3 * DAY, "r2")
    assert opened["old.csv"] and opened["more.csv"] and "new.csv" not in opened
    assert rows["old.csv"] == (2, 1, 1, 1) and rows["more.csv"] == (1, 1, 1, 0)
    rows, opened, _ = _run(spark, folder, t, ts + 3 * DAY, "r2")                             # the same run again: same decisions
    assert opened["old.csv"] and opened["more.csv"] and rows["old.csv"] == (2, 1, 1, 1)
    rows, opened, _ = _run(spark, folder, t, ts + 5 * DAY, "r3")
    assert not opened["old.csv"] and not opened["more.csv"] and opened["none.csv"]


def test_resets_and_reloads_open_files_again(spark, folder, tmp_path):
    from feedrecon.operators import control as CT
    t = IG.Tables(f"file:{tmp_path}/t")
    ts = dt.datetime(2022, 1, 1)
    _run(spark, folder, t, ts, "r1")
    CT.reset(spark, t.control, ts, "reset", ("v3",))
    rows, opened, _ = _run(spark, folder, t, ts + DAY, "r2")
    assert opened["old.csv"] and rows["old.csv"] == (2, 2, 2, 0)
    rows, opened, _ = _run(spark, folder, t, ts + DAY, "r3", full_reload=True)
    assert opened["old.csv"] and IG.read_staging(spark, t).count() == 6


def test_a_grown_registry_reads_unknown_files_anew(spark, folder, tmp_path):
    from feedrecon.layouts import LAYOUTS, Layout
    t = IG.Tables(f"file:{tmp_path}/t")
    _run(spark, folder, t, dt.datetime(2022, 1, 1), "r1")
    lay = Layout(version="v9", student_id="x", full_name="y", school_id="z", credential_type="c", issue_date="d", status="s", updated_at="u",
                 columns=("x", "y"), fingerprint=("x", "y"), position=8)
    rows, opened, totals = _run(spark, folder, t, dt.datetime(2022, 2, 1), "r2", layouts={**LAYOUTS, "v9": lay})
    assert opened["bad.csv"] and rows["bad.csv"][0] == 1


def test_unopened_files_are_not_in_the_plan(spark, folder, tmp_path, monkeypatch):
    """One scan of the opened files writes everything; what is counted afterwards is what was written."""
    t = IG.Tables(f"file:{tmp_path}/t")
    _run(spark, folder, t, dt.datetime(2022, 1, 1), "r1")
    seen = []
    real = IG.load_rows
    monkeypatch.setattr(IG, "load_rows", lambda flagged, *a: seen.append(flagged) or real(flagged, *a))
    real_summary = IG.summary_of
    monkeypatch.setattr(IG, "summary_of", lambda loaded, *a: seen.append(loaded) or real_summary(loaded, *a))
    _run(spark, folder, t, dt.datetime(2022, 1, 2), "r2")
    read = {os.path.basename(f) for f in seen[0].inputFiles()}
    assert read == {"new.csv", "none.csv"}
    assert plan_text(seen[0]).count("Scan csv") == 2                     # (its tree and its details)
    assert "csv" not in plan_text(seen[1]).lower().replace("feed", "") or "Scan parquet" in plan_text(seen[1])


def test_a_folder_of_many_files_without_a_list_per_file(spark, folder, tmp_path, monkeypatch):
    """Beyond ``FEW`` files: stored file tables, one scan joined by path, the driver sees distinct headers only."""
    d = f"{tmp_path}/many"
    for i in range(40):
        head = V3 if i % 3 else V3.replace("stu_id,firstName", "firstName,stu_id")
        row = f"stu{100 + i},Ed{i},Ng,S1,GED,2020-01-02,ACT,\n" if i % 3 else f"Ed{i},stu{100 + i},Ng,S1,GED,2020-01-02,ACT,\n"
        _write(d, f"f{i:02}.csv", text=head + row)
    _write(d, "lost.csv", text="x,y,z\n1,2,3\n")
    _write(d, "empty.csv", text="")
    _write(d, "_hid.csv", text=V3)
    _write(f"{d}/folder.csv", "notes.txt", text="no feed\n")
    few, _ = CSV.read_feeds(spark, f"file:{d}")
    want = sorted(map(repr, few.collect()))
    listed = sorted(map(repr, CSV.list_files(spark, f"file:{d}").drop("modified").collect()))
    classified = sorted((r.feed, r.version, r.detection) for r in CSV.classify_directory(spark, f"file:{d}").collect())
    monkeypatch.setattr(CSV, "FEW", 5)
    monkeypatch.setattr(CSV, "LOCAL_LISTING", 5)
    assert sorted(map(repr, CSV.list_files(spark, f"file:{d}").drop("modified").collect())) == listed and len(listed) == 43
    many, c = CSV.read_feeds(spark, f"file:{d}")
    plan = plan_text(many)
    assert sorted((r.feed, r.version, r.detection) for r in c.collect()) == classified
    assert sorted(map(repr, many.collect())) == want and len(want) == 40
    assert plan.split("\n\n")[0].count("Scan csv") == 1 and "Join" in plan
    counts = {r.feed: r.source_count for r in CSV.feed_counts(spark, f"file:{d}", c).collect()}
    assert counts["f00.csv"] == 1 and counts["lost.csv"] == 1 and counts["empty.csv"] == 0 and counts["_hid.csv"] == 0
    t = IG.Tables(f"file:{tmp_path}/t")
    _, totals = ingest_directory(spark, f"file:{d}", t, dt.datetime(2022, 1, 1), "r1")
    assert (totals.first().staged, totals.first().errors) == (40, 3)
    assert {r.status for r in reconcile_directory(spark, f"file:{d}", t).where("check_name LIKE '%f0%'").collect()} == {"FAIL"}      # 10 files, one layout


def test_a_folder_with_a_csv_name_is_no_feed(spark, tmp_path):
    d = f"{tmp_path}/in"
    _write(d, "a.csv", (1, ""))
    _write(f"{d}/b.csv", "notes.txt", text="x\n")
    _write(f"{d}/b.csv", "part.csv", (2, ""))
    assert [os.path.basename(p) for p in CSV.list_feeds(spark, f"file:{d}")] == ["a.csv"]
