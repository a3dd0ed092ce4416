"""Plans and rules whose cost must not depend on how the input came."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from feedrecon.functions import rules as R
from feedrecon.operators import ingest as IG
from feedrecon.plans import scenarios as S
from feedrecon.session import at_once, small_methods
from feedrecon.sources import fixtures as FX
from tests.plan_utils import plan_text


def _tables(spark, folder) -> str:
    spark.createDataFrame([(k, 1 + k % 3, "O", dt.datetime(1996, 1, 2)) for k in range(40)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(c, f"Customer#{c:09d}", "BUILDING", 3) for c in (1, 2, 3)],
                          "c_custkey long, c_name string, c_mktsegment string, c_nationkey int").coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_orders_of_one_file_are_dealt_out_before_cells_are_rendered(spark, tmp_path):
    text = plan_text(S.derived_feeds(spark, _tables(spark, tmp_path)))
    assert "REPARTITION_BY_COL" in text


def test_literal_picks_stay_null_outside_the_list(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (-1,), (None,)], "i long")
    assert [r[0] for r in df.select(FX._pick(F.col("i"), ("a", "b"), base=1)).collect()] == [None, "a", "b", None, None, None]


def test_wide_rows_are_written_without_methods_the_jvm_leaves_uncompiled(spark, tmp_path, monkeypatch):
    seen, key = [], "spark.sql.codegen.hugeMethodLimit"
    load = IG.load_rows
    monkeypatch.setattr(IG, "load_rows", lambda *a, **k: (seen.append(spark.conf.get(key)), load(*a, **k))[1])
    before = spark.conf.get(key, None)
    feed = S.derived_feeds(spark, _tables(spark, tmp_path / "in"))
    IG.run_ingest(spark, feed, IG.Tables(str(tmp_path / "out")), S.LOAD_TS, "r")
    assert int(seen[0]) < 8000 and spark.conf.get(key, None) == before
    with pytest.raises(ValueError), small_methods(spark):
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_rules_do_not_split_by_patterns_row_by_row(spark):
    df = spark.createDataFrame([("0000-01-01", "2020-01-01T12", " a　b \tc ")], "d string, u string, n string")
    out = df.select(R.parse_issue_date("d"), R.lenient_updated_at("u"), *R.split_full_name("n"))
    assert "split(" not in plan_text(out)
    assert tuple(out.first()) == (None, dt.datetime(2020, 1, 1, 12), "a b", "c")


def test_writes_run_side_by_side_and_an_error_is_raised(spark):
    both = threading.Barrier(2, timeout=30)
    at_once(spark, both.wait, both.wait)
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1 / 0, lambda: None)
