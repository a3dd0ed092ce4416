"""Real CSV feeds on storage: quoting, blank and
short/long rows, byte-order mark, duplicate header names, unknown feeds."""

import os

from pyspark.sql import functions as F

from feedrecon.operators import normalise as N
from feedrecon.sources import csv_feeds as CSV


def _write(folder, name, text, bom=False):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(text)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


V2_HEADER = "studentId,first_name,last_name,school_id,cred_type,issue_date,credentialStatus,preferredName,last_modified\n"


def test_read_classify_and_map(spark, tmp_dir):
    d = _local(tmp_dir)
    _write(d, "a_v2.csv", V2_HEADER
           + 'S100001,"Ann ""Jo""",Lee,DIST001-SCH001,ged,01/05/2021,Active,N/A,2021-02-01T00:00:00\n'
           + "\n"
           + "S100002,Bo,Li,DIST001-SCH002,ap credit,02/06/2021,Expired,Bee,2021-02-01T00:00:00,EXTRA\n"
           + "S100003,Cy,Xu\n"
           + "S100004,Di,C:\\\\path,DIST001-SCH003,ged,03/07/2021,Pending,,\n")
    _write(d, "b_unknown.csv", "foo,bar\n1,2\n")
    _write(d, "d_empty.csv", "")
    _write(d, "c_v3_bom.csv", "stu_id,firstName,lastName,school_code,credential_category,issued_on,status_code,"
           "modified_timestamp\nstu100009,Ed,Ng,DIST002-SCH001,GED,2020-01-02,ACT,\n", bom=True)
    slots, classified = CSV.read_feeds(spark, d)
    versions = {r.feed: r.version for r in classified.collect()}
    assert versions == {"a_v2.csv": "v2", "b_unknown.csv": "UNKNOWN", "c_v3_bom.csv": "v3", "d_empty.csv": "UNKNOWN"}
    det = {r.feed: r.detection for r in classified.collect()}
    assert det["a_v2.csv"] == "v2" and det["b_unknown.csv"].startswith(
        "UNKNOWN: Unknown schema version. Column set does not match any of the 8 known fingerprints.\n"
        "Columns found: ['bar', 'foo']")
    assert [r.feed for r in classified.collect()] == sorted(versions)
    tagged = N.tag(slots, "feed")
    rows = {r.source_student_id: r for r in tagged.collect()}
    assert rows["S100001"].first_name == 'Ann "Jo"' and rows["S100001"].preferred_name is None
    assert rows["S100002"].credential_type == "AP_CREDIT" and rows["S100002"].preferred_name == "Bee"
    assert rows["S100003"].reasons == ["missing_school_id", "unparseable_issue_date"]   # short row: cells read as ""
    assert rows["S100004"].last_name == "C:\\\\path"                                       # backslashes kept
    assert rows["stu100009"].student_id == "100009" and rows["stu100009"].status == "ACTIVE"
    assert len(rows) == 5                                                                 # blank line skipped
    counts = {r.feed: r.source_count for r in CSV.count_records(spark, d).collect()}
    assert counts["a_v2.csv"] == 4 and counts["c_v3_bom.csv"] == 1


def test_duplicate_header_names_bind_by_position(spark, tmp_dir):
    d = _local(tmp_dir)
    _write(d, "dup.csv", "id,id,name_first,name_last,schl_id,credType,issuedDate,state,modified\n"
           "777,888,A,B,S1,GED,2020-01-02T00:00:00Z,active,\n")
    slots, classified = CSV.read_feeds(spark, d)
    assert [r.version for r in classified.collect()] == ["v6"]
    r = N.tag(slots).collect()[0]
    assert r.student_id == "888" and r.issue_date.isoformat() == "2020-01-02"   # last 'id' wins


def test_empty_folder_has_no_feeds(spark, tmp_dir):
    d = _local(tmp_dir)
    os.makedirs(d, exist_ok=True)
    assert CSV.list_feeds(spark, d) == []
    slots, classified = CSV.read_feeds(spark, d)
    assert slots is None and classified.count() == 0


def test_embedded_newline_with_multiline(spark, tmp_dir):
    d = _local(tmp_dir)
    _write(d, "ml.csv", V2_HEADER + 'S100001,"Ann\nMarie",Lee,DIST001-SCH001,ged,01/05/2021,Active,N/A,\n'
           + "S100002,Bo,Li,DIST001-SCH002,ged,01/05/2021,Active,N/A,\n")
    slots, _ = CSV.read_feeds(spark, d)
    rows = {r.source_student_id: r for r in N.tag(slots).collect()}
    assert len(rows) == 2 and rows["S100001"].first_name == "Ann\nMarie"


def test_folder_row_counts_against_staging(spark, tmp_dir):
    from feedrecon.operators import checks as C
    d = _local(tmp_dir)
    _write(d, "a_v2.csv", V2_HEADER + "S100001,A,B,S1,ged,01/05/2021,Active,N/A,\nS100002,A,B,,ged,01/05/2021,Active,N/A,\n")
    _write(d, "z_empty.csv", "")
    slots, classified = CSV.read_feeds(spark, d)
    res = {r.check_name: r for r in C.reconcile_row_counts(CSV.feed_counts(spark, d, classified),
                                                           N.normalise(slots)).collect()}
    assert res["Row count: v2 (a_v2.csv)"].detail.startswith("source=2, staged=1, delta=-1 (50.00%")
    assert res["Row count: z_empty.csv"].status == "FAIL"


def test_directory_jobs_end_to_end(spark, sf_small, tmp_dir):
    """Export the staged sample to one CSV feed per layout plus an unreadable
    file, ingest the folder, reconcile it, and check the gate."""
    from pyspark.sql import functions as F

    from feedrecon.functions.rules import ntz
    from feedrecon.layouts import LAYOUTS
    from feedrecon.operators import export as EX
    from feedrecon.operators import ingest as IG
    from feedrecon.operators import report as RP
    from feedrecon.plans import scenarios as S
    from feedrecon.plans.jobs import ingest_directory, reconcile_directory
    st = S.staging(spark, sf_small)
    src = f"{tmp_dir}/feeds"
    for v, lay in LAYOUTS.items():
        EX.write_csv(EX.export_layout(st.where(F.col("source_schema_version") == v), lay, ntz(S.LOAD_TS)),
                     f"{tmp_dir}/parts/{v}")
    d = _local(src)
    os.makedirs(d, exist_ok=True)
    for v in LAYOUTS:
        part_dir = _local(f"{tmp_dir}/parts/{v}")
        for name in os.listdir(part_dir):
            if name.endswith(".csv"):
                os.rename(os.path.join(part_dir, name), os.path.join(d, f"credentials_{v}.csv"))
    _write(d, "notes.csv", "foo,bar\n1,2\n")
    target = IG.Tables(f"{tmp_dir}/target")
    summary, totals = ingest_directory(spark, src, target, S.RUN1_TS, "r1")
    t = totals.collect()[0]
    assert t.staged == st.count() and t.errors == 1 and t.status == "COMPLETED WITH WARNINGS"
    results = {r.check_name: r for r in reconcile_directory(spark, src, target).collect()}
    assert results["Row count: v1 (credentials_v1.csv)"].status == "PASS"
    assert results["Row count: notes.csv"].status == "FAIL"
    assert RP.overall(reconcile_directory(spark, src, target)).collect()[0].overall_status == "FAIL"


def test_permuted_and_extra_columns_change_nothing(spark, sf_small, tmp_dir):
    """SURVEY §5 (5): the same records written with the columns in another
    order and with extra columns classify and map to the same rows."""
    from pyspark.sql import functions as F

    from feedrecon.functions.rules import ntz
    from feedrecon.layouts import LAYOUTS
    from feedrecon.operators import export as EX
    from feedrecon.plans import scenarios as S
    st = S.staging(spark, sf_small)
    for v in ("v1", "v4", "v6"):
        lay = LAYOUTS[v]
        out = EX.export_layout(st.where(F.col("source_schema_version") == v), lay, ntz(S.LOAD_TS))
        EX.write_csv(out, f"{tmp_dir}/plain/{v}")
        shuffled = out.select(F.lit("x").alias("extra_a"), *reversed(lay.columns), F.lit("").alias("extra_b"))
        EX.write_csv(shuffled, f"{tmp_dir}/permuted/{v}")
    a, ca = CSV.read_feeds(spark, f"{tmp_dir}/plain/*")
    b, cb = CSV.read_feeds(spark, f"{tmp_dir}/permuted/*")
    assert sorted(r.version for r in ca.collect()) == sorted(r.version for r in cb.collect())
    na, nb = N.normalise(a).drop("feed"), N.normalise(b).drop("feed")
    assert na.count() == nb.count() and na.exceptAll(nb).count() == 0


V2_ROW = "S100001,A,B,S1,ged,01/05/2021,Active,N/A,2021-02-01T00:00:00\n"
V3_HEADER = "stu_id,firstName,lastName,school_code,credential_category,issued_on,status_code,modified_timestamp\n"


def test_hidden_and_partition_like_names(spark, tmp_dir):
    """Names Spark would skip are reported as unknown; folders named like partitions hide nothing."""
    d = _local(tmp_dir)
    for name in ("top.csv", "_x.csv", ".y.csv", "a b%20c.csv"):
        _write(d, name, V2_HEADER + V2_ROW)
    _write(f"{d}/p=1", "in.csv", V2_HEADER + V2_ROW)
    _write(f"{d}/q=1", "in.csv", V2_HEADER + V2_ROW)
    slots, classified = CSV.read_feeds(spark, d)
    rows = {r.feed: r for r in classified.collect()}
    assert set(rows) == {"top.csv", "_x.csv", ".y.csv", "a b%20c.csv"}
    assert rows["_x.csv"].version == "UNKNOWN" and "hidden" in rows["_x.csv"].detection
    assert sorted(r.feed for r in slots.collect()) == ["a b%20c.csv", "top.csv"]
    counts = {r.feed: (r.ver, r.source_count) for r in CSV.feed_counts(spark, d, classified).collect()}
    assert counts["a b%20c.csv"] == ("v2", 1) and counts["_x.csv"] == (None, 0)


def test_a_folder_that_cannot_be_listed_raises(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        CSV.list_feeds(spark, f"{tmp_dir}/nowhere")
    with pytest.raises(Exception, match="nostore"):
        CSV.list_feeds(spark, "nostore://host/feeds")


def test_equal_names_in_two_folders(spark, tmp_dir):
    d = _local(tmp_dir)
    _write(f"{d}/s1", "c.csv", V2_HEADER + V2_ROW)
    _write(f"{d}/s2", "c.csv", V2_HEADER + V2_ROW + V2_ROW.replace("100001", "100002"))
    counts = {r.feed: r.source_count for r in CSV.feed_counts(spark, f"{d}/*").collect()}
    assert counts == {"s1/c.csv": 1, "s2/c.csv": 2}
    slots, _ = CSV.read_feeds(spark, f"{d}/*")
    assert sorted(r.feed for r in slots.collect()) == ["s1/c.csv", "s2/c.csv", "s2/c.csv"]


def test_quoted_newlines_load_and_reconcile_by_default(spark, tmp_dir):
    from feedrecon.operators import ingest as IG
    from feedrecon.plans import scenarios as S
    from feedrecon.plans.jobs import ingest_directory, reconcile_directory
    d = _local(f"{tmp_dir}/feeds")
    _write(d, "ml.csv", V2_HEADER + 'S100001,"Ann\nMarie",Lee,DIST001-SCH001,ged,01/05/2021,Active,N/A,2021-02-01T00:00:00\n'
           + V2_ROW.replace("100001", "100002"))
    target = IG.Tables(f"{tmp_dir}/target")
    _, totals = ingest_directory(spark, f"{tmp_dir}/feeds", target, S.RUN1_TS, "r1")
    assert totals.collect()[0].staged == 2
    res = {r.check_name: r for r in reconcile_directory(spark, f"{tmp_dir}/feeds", target).collect()}
    assert res["Row count: v2 (ml.csv)"].status == "PASS"


def test_header_reader_is_self_contained_and_survives_short_reads(tmp_path):
    """The task's function runs where this package is not importable."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    (tmp_path / "h.csv").write_bytes('\ufeffa,"b\nc",d\n1,2,3\n'.encode())
    (tmp_path / "f").write_bytes(cloudpickle.dumps(CSV._header_reader(3)[0]))
    out = subprocess.run([sys.executable, "-c", "import pickle,sys;f=pickle.load(open('f','rb'));print(f('h.csv'))"],
                         cwd=tmp_path, env={"PATH": os.environ["PATH"]}, capture_output=True, text=True, check=True)
    assert out.stdout.strip().splitlines()[-1] == str(["a", "b\nc", "d"])


def test_header_only_feed_is_summarised_and_advances(spark, tmp_dir):
    from feedrecon.operators import control as CT
    from feedrecon.operators import ingest as IG
    from feedrecon.plans import scenarios as S
    from feedrecon.plans.jobs import ingest_directory, reconcile_directory
    d = _local(f"{tmp_dir}/feeds")
    _write(d, "a_v2.csv", V2_HEADER)
    _write(d, "b_v3.csv", V3_HEADER + "stu100009,Ed,Ng,DIST002-SCH001,GED,not a date,ACT,\n")
    target = IG.Tables(f"{tmp_dir}/target")
    summary, _ = ingest_directory(spark, f"{tmp_dir}/feeds", target, S.RUN1_TS, "20240102")
    rows = {r.file: r for r in summary.collect()}
    assert rows["a_v2.csv"].total_rows == 0 and rows["b_v3.csv"].mapping_errors == 1
    state = {r.schema_version for r in CT.current_state(CT.read_log(spark, target.control)).collect()}
    assert state == {"v2"}                                  # v3 rejected everything
    q = IG.read_quarantine(spark, target).collect()
    assert [(r.raw_issue_date, r.reason, r.run_id) for r in q] == [("not a date", "unparseable_issue_date", "20240102")]
    res = {r.check_type: r for r in reconcile_directory(spark, f"{tmp_dir}/feeds", target).collect()}
    assert res["NULL_ASSERTIONS"].check_name == "Null assertions: staging table" and res["NULL_ASSERTIONS"].status == "FAIL"


def test_full_reload_of_an_empty_folder_empties_staging(spark, tmp_dir):
    from feedrecon.operators import ingest as IG
    from feedrecon.plans import scenarios as S
    from feedrecon.plans.jobs import ingest_directory
    d = _local(f"{tmp_dir}/feeds")
    _write(d, "a_v2.csv", V2_HEADER + V2_ROW + "S1,A,B,,ged,01/05/2021,Active,N/A,\n")
    target = IG.Tables(f"{tmp_dir}/target")
    ingest_directory(spark, f"{tmp_dir}/feeds", target, S.RUN1_TS, "r1")
    assert IG.read_staging(spark, target).count() == 1 and IG.read_quarantine(spark, target).count() == 1
    os.makedirs(_local(f"{tmp_dir}/none"))
    ingest_directory(spark, f"{tmp_dir}/none", target, S.RUN2_TS, "r2", full_reload=True)
    assert IG.read_staging(spark, target).count() == 0 and IG.read_quarantine(spark, target).count() == 0


def test_a_ninth_layout_as_data(spark, tmp_dir):
    from feedrecon.functions.rules import STATUS_WORDS
    from feedrecon.layouts import LAYOUTS, Layout
    from feedrecon.operators import ingest as IG
    from feedrecon.plans import scenarios as S
    from feedrecon.plans.jobs import ingest_directory, reconcile_directory
    cols = ("pupil", "whole_name", "campus", "award", "on_date", "condition", "touched")
    lay = Layout(version="v9", student_id="pupil", full_name="whole_name", school_id="campus", credential_type="award",
                 issue_date="on_date", status="condition", updated_at="touched", columns=cols, fingerprint=cols[:6], position=8)
    d = _local(f"{tmp_dir}/feeds")
    _write(d, "nine.csv", ",".join(cols) + "\nP100001,Ann Marie Lee,C1,diploma x,2021-01-05,vivant,2021-02-01T00:00:00\n")
    layouts, target = {**LAYOUTS, "v9": lay}, IG.Tables(f"{tmp_dir}/target")
    ingest_directory(spark, f"{tmp_dir}/feeds", target, S.RUN1_TS, "r1", layouts=layouts,
                     status_words={**STATUS_WORDS, "vivant": "ACTIVE"})
    r = IG.read_staging(spark, target).collect()[0]
    assert (r.student_id, r.first_name, r.last_name, r.status, r.source_schema_version) == ("100001", "Ann Marie", "Lee", "ACTIVE", "v9")
    res = {x.check_name: x.status for x in reconcile_directory(
        spark, f"{tmp_dir}/feeds", target, layouts=layouts, allowed_types=("DIPLOMA_X",)).collect()}
    assert res["Row count: v9 (nine.csv)"] == "PASS" and res["credential_type: allowed values check"] == "PASS"
