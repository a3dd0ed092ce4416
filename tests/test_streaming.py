"""Streaming ingest: one stream of file names for all layouts, routed by real headers."""

import datetime as dt
import os

from feedrecon.operators import control as CT
from feedrecon.operators import ingest as IG
from feedrecon.plans import scenarios as S
from feedrecon.streaming.ingest_stream import start_ingest_stream

V2 = "studentId,first_name,last_name,school_id,cred_type,issue_date,credentialStatus,preferredName,last_modified\n"
V2_TURNED = "last_modified,school_id,first_name,last_name,extra,studentId,cred_type,issue_date,credentialStatus,preferredName\n"
V3 = "stu_id,firstName,lastName,school_code,credential_category,issued_on,status_code,modified_timestamp\n"


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def _run(spark, d, target, ts=S.LOAD_TS, **options):
    q = start_ingest_stream(spark, f"file:{d}/in", target, f"{d}/ckpt", "s", run_ts=lambda e: ts, **options)
    q.awaitTermination()
    return {r.source_student_id: r for r in IG.read_staging(spark, target).collect()}


def test_files_are_routed_by_their_headers(spark, tmp_path):
    d, target = str(tmp_path), IG.Tables(f"file:{tmp_path}/out")
    _write(f"{d}/in", "a.csv", V2 + "S100001,Ann,Lee,DIST001-SCH001,ged,01/05/2021,Active,N/A,2021-02-01T00:00:00\n")
    _write(f"{d}/in", "turned.csv", V2_TURNED + "2021-02-01T00:00:00,DIST001-SCH002,Bo,Li,x,S100002,ged,01/05/2021,Active,N/A\n")
    _write(f"{d}/in", "three.csv", V3 + "stu100003,Cy,Xu,DIST002-SCH001,GED,2020-01-02,ACT,\n")
    _write(f"{d}/in", "lost.csv", V2.replace("studentId,", "") + "Ann,Lee,DIST001-SCH001,ged,01/05/2021,Active,N/A,\n")
    _write(f"{d}/in", "_hidden.csv", V2)
    _write(f"{d}/in", "empty.csv", "")
    rows = _run(spark, d, target)
    assert set(rows) == {"S100001", "S100002", "stu100003"}
    assert (rows["S100002"].first_name, rows["S100002"].school_id, rows["S100002"].source_schema_version) == ("Bo", "DIST001-SCH002", "v2")
    assert rows["stu100003"].source_schema_version == "v3"
    files = {r.file: r for r in IG.read_files(spark, target).collect()}
    unknown = {f for f, r in files.items() if r.schema_version is None}
    # an empty file is never handed over by Spark's file source: it has neither header nor record
    assert {"in/lost.csv", "in/_hidden.csv"} <= unknown <= {"in/lost.csv", "in/_hidden.csv", "in/empty.csv"}
    assert files["in/lost.csv"].detection.startswith("UNKNOWN: Unknown schema version") and "hidden" in files["in/_hidden.csv"].detection


def test_new_files_are_picked_up_and_old_ones_left(spark, tmp_path):
    d, target = str(tmp_path), IG.Tables(f"file:{tmp_path}/out")
    row = "S10000{0},A,B,S1,ged,01/05/2021,Active,N/A,{1}\n"
    _write(f"{d}/in", "a.csv", V2 + row.format(1, "2021-02-01T00:00:00"))
    assert len(_run(spark, d, target)) == 1
    # its record was updated long before the first run: a new file is loaded whole all the same
    _write(f"{d}/in", "b.csv", V2 + row.format(2, "2018-02-01T00:00:00"))
    _write(f"{d}/in", ".later.csv", V2)
    assert set(_run(spark, d, target, S.LOAD_TS + dt.timedelta(days=2))) == {"S100001", "S100002"}
    assert _run(spark, d, target).keys() == {"S100001", "S100002"}                  # nothing new: no run
    assert IG.read_staging(spark, target).count() == 2
    hidden = IG.read_files(spark, target).where("schema_version IS NULL").collect()
    assert [r.file for r in hidden] == ["in/.later.csv"]
    state = CT.current_state(CT.read_log(spark, target.control)).collect()
    assert [(r.schema_version, str(r.last_processed_at)) for r in state] == [("v2", "2021-02-01 00:00:00")]      # never backwards


def test_small_batches_and_several_folders(spark, tmp_path):
    d, target = str(tmp_path), IG.Tables(f"file:{tmp_path}/out")
    for i in range(4):
        _write(f"{d}/in/f{i % 2}", f"same{i // 2}.csv", V2 + f'S10000{i},"A\nB",C,S1,ged,01/05/2021,Active,N/A,\n')
    q = start_ingest_stream(spark, f"file:{d}/in/*", target, f"{d}/ckpt", "s", run_ts=lambda e: S.LOAD_TS, max_files_per_trigger=1)
    q.awaitTermination()
    got = IG.read_staging(spark, target).collect()
    assert sorted(r.source_student_id for r in got) == [f"S10000{i}" for i in range(4)] and len({r.run_id for r in got}) == 4
    assert {r.first_name for r in got} == {"A\nB"}
    assert {r.file for r in IG.read_files(spark, target).collect()} == {"f0/same0.csv", "f0/same1.csv", "f1/same0.csv", "f1/same1.csv"}
