"""Plan shape: no Python on any path, pruned scans, one exchange for the
per-student conflict profile, filters reaching the scan."""

import pytest

from feedrecon.operators import checks as C
from feedrecon.plans import scenarios as S
from feedrecon.plans.catalog import REGISTRY
from tests.plan_utils import plan_text

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", ["normalise_all", "recon_results", "feed_classify", "dedupe_exact",
                                  "export_v5", "row_counts"])
def test_no_python_in_plans(spark, sf_small, name):
    text = plan_text(REGISTRY[name](spark, sf_small))
    assert not any(n in text for n in PY_NODES)


def test_profile_single_exchange(spark, sf_small):
    prof = C.hash_flags(C.student_hashes(S.staging(spark, sf_small)))
    text = plan_text(prof)
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Expand" not in tree


def test_staging_scan_is_pruned(spark, sf_small):
    text = plan_text(REGISTRY["school_conflicts"](spark, sf_small))
    assert "ReadSchema: struct<student_id:string,school_id:string>" in text


def test_suite_scans_staging_four_times(spark, sf_small):
    """Once the plan has run: row counts, value checks, duplicates, students; the rest reuses their shuffles."""
    df = REGISTRY["recon_results"](spark, sf_small)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    scans = [line for line in final.split("\n") if "FileScan" in line and "/loads" in line]
    assert len(scans) == 4 and final.count("ReusedExchange") == 3
