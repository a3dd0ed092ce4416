"""Documented-only extensions and the latest-per-key view."""

import datetime as dt

from feedrecon.operators import extensions as XT


def test_latest_per_key_with_a_hot_key(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    rows = [("v1", "STU1", t1, "r1", "A") for _ in range(300)] + [("v1", "STU1", t2, "r2", "B")]
    rows += [("v2", f"S{i}", t1, "r1", "C") for i in range(600)]
    df = spark.createDataFrame(rows, "source_schema_version string, source_student_id string, "
                                     "staged_at timestamp_ntz, run_id string, school_id string")
    out = {(r.source_schema_version, r.source_student_id): r for r in XT.latest_per_key(df).collect()}
    assert len(out) == 601
    assert out[("v1", "STU1")].school_id == "B" and out[("v1", "STU1")].run_id == "r2"


def test_dedupe_keeps_one_row_per_key(spark):
    d = dt.date(2020, 1, 1)
    rows = [("1", "S", "GED", d, "v2", "S1", "A", "B", None, "ACTIVE"),
            ("1", "S", "GED", d, "v1", "STU1", "A", "B", "P", "ACTIVE"),
            ("2", "S", "GED", d, "v1", "STU2", "C", "D", None, "ACTIVE")]
    df = spark.createDataFrame(rows, "student_id string, school_id string, credential_type string, issue_date date, "
                                     "source_schema_version string, source_student_id string, first_name string, "
                                     "last_name string, preferred_name string, status string")
    out = {r.student_id: r for r in XT.dedupe_exact(df).collect()}
    assert len(out) == 2 and out["1"].source_schema_version == "v1"      # smallest by layout first


def test_school_dimension_and_orphans(spark):
    nation = spark.createDataFrame([(0,), (1,)], "n_nationkey int")
    dim = XT.school_dimension(nation)
    assert dim.count() == 60
    st = spark.createDataFrame([("DIST000-SCH001", "1"), ("DIST001-SCH999", "2"), ("DIST001-SCH999", "3")],
                               "school_id string, student_id string")
    o = XT.orphan_schools(st, dim).collect()
    assert [(r.school_id, r.rows, r.students) for r in o] == [("DIST001-SCH999", 2, 2)]
