"""Reconciliation checks on small hand-made staging frames."""

import datetime as dt

import pytest

from feedrecon.operators import checks as C
from feedrecon.operators import report as RP

SCHEMA = ("student_id string, first_name string, last_name string, preferred_name string, school_id string, "
          "credential_type string, issue_date date, status string, source_schema_version string, "
          "source_student_id string")


def _stg(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


D = dt.date(2020, 1, 1)
ROWS = [
    ("100001", "A", "B", None, "S1", "GED", D, "ACTIVE", "v1", "STU100001"),
    ("100001", "A", "B", None, "S1", "GED", D, "ACTIVE", "v2", "S100001"),      # exact duplicate, other version
    ("100001", "A", "B", None, "S2", "AP_CREDIT", D, "ACTIVE", "v3", "stu100001"),  # other school + type
    ("12", "C", "", None, "S3", "BOGUS", D, "UNKNOWN", "v1", "STU12"),
]


def test_empty_staging_single_fail_row(spark):
    r = C.null_assertions(_stg(spark, [])).collect()
    assert len(r) == 1 and r[0].status == "FAIL" and r[0].check_name == "Null assertions: staging table"


def test_checks_on_small_staging(spark):
    stg = _stg(spark, ROWS)
    nulls = {r.check_name: r for r in C.null_assertions(stg).collect()}
    assert nulls["Null check: last_name"].status == "FAIL"
    assert nulls["Null check: last_name"].detail == "null_count=1, null_pct=25.00% EXCEEDS threshold=0.0%"
    assert nulls["Null check: preferred_name"].status == "PASS"
    integ = {r.seq: r for r in C.referential_integrity(stg).collect()}
    assert integ[1].status == "FAIL" and integ[1].sample_values == ["12"]
    assert integ[2].status == "FAIL" and integ[2].detail.endswith("['BOGUS']")
    assert integ[3].status == "WARNING" and integ[3].actual == "1"
    dup = {r.seq: r for r in C.duplicate_detection(stg).collect()}
    assert dup[1].actual == "1" and "(1 excess rows)" in dup[1].detail
    assert dup[2].status == "FAIL" and dup[2].sample_values == ["100001"]
    cv = C.check_cross_version(C.student_profile(stg)).collect()[0]
    assert cv.status == "WARNING" and cv.sample_values == ["100001"]


def test_no_multi_version_single_pass_row(spark):
    cv = C.check_cross_version(C.student_profile(_stg(spark, ROWS[3:]))).collect()[0]
    assert cv.check_name == "Students appearing in multiple schema versions" and cv.status == "PASS"


def test_row_counts_tolerance_and_unknown(spark):
    feeds = spark.createDataFrame([("f1.csv", "v1", 100), ("f2.csv", "v2", 0), ("x.csv", None, 5)],
                                  "feed string, ver string, source_count long")
    stg = _stg(spark, [ROWS[0]] * 99 + [ROWS[1]])
    res = {r.check_name: r for r in C.reconcile_row_counts(feeds, stg, tolerance_pct=1.0).collect()}
    assert res["Row count: v1 (f1.csv)"].status == "WARNING"
    assert res["Row count: v1 (f1.csv)"].detail == "source=100, staged=99, delta=-1 (1.00% — within 1.0% tolerance)"
    assert res["Row count: v2 (f2.csv)"].status == "WARNING"        # source 0, staged > 0
    assert res["Row count: x.csv"].status == "FAIL"


def test_gate(spark):
    stg = _stg(spark, ROWS)
    feeds = spark.createDataFrame([("f.csv", "v1", 2)], "feed string, ver string, source_count long")
    results = RP.build_results(feeds, stg)
    assert RP.overall(results).collect()[0].overall_status == "FAIL"
    with pytest.raises(RP.GateFailed):
        RP.assert_gate(results)
    lines = [r.line for r in RP.render(results, "run-1", "2024-01-01 00:00:00 UTC").orderBy("line_no").collect()]
    assert lines[2].endswith("RECONCILIATION REPORT") and lines[-4].startswith("  Passed")


def test_publish_only_when_gate_open(spark, tmp_dir):
    import datetime as _d
    stg = _stg(spark, ROWS[:1])
    feeds_ok = spark.createDataFrame([("f.csv", "v1", 1)], "feed string, ver string, source_count long")
    ok = RP.build_results(feeds_ok, stg)
    assert RP.publish_if_passed(ok, stg, f"{tmp_dir}/gold", "v1") == "PASS"
    assert RP.read_published(spark, f"{tmp_dir}/gold").count() == 1
    bad = RP.build_results(spark.createDataFrame([("f.csv", "v1", 5)], "feed string, ver string, source_count long"), stg)
    with pytest.raises(RP.GateFailed):
        RP.publish_if_passed(bad, stg, f"{tmp_dir}/gold2", "v1")
    assert RP.suite_run_id(_d.datetime(2024, 1, 2, 3, 4, 5)) == "sim_run_20240102_030405"
