"""The suite from kept partial aggregates, hashed profiles, the saved report, versioned publishing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedrecon.operators import checks as C
from feedrecon.operators import ingest as IG
from feedrecon.operators import normalise as N
from feedrecon.operators import report as RP
from feedrecon.operators import suite_state as SS
from feedrecon.plans import scenarios as S
from tests.plan_utils import plan_text


def _rows(df):
    return sorted(map(repr, df.collect()))


def _same(spark, target, feed_counts, options=SS.Options()):
    staging = IG.read_staging(spark, target).select(*N.CANONICAL)
    kept = SS.results(feed_counts, SS.state(spark, target, options), staging, options=options)
    assert _rows(kept) == _rows(RP.build_results(feed_counts, staging))
    return kept


def test_state_follows_runs_compaction_and_reload(spark, sf_small, tmp_dir):
    f, t = S.feeds(spark, sf_small), IG.Tables(f"{tmp_dir}/t")
    counts = C.source_counts(f)
    IG.run_ingest(spark, S.delivery(f, S.RUN1_TS, include_late=False), t, S.RUN1_TS, "r1")
    with pytest.raises(ValueError, match="update it first"):
        SS.state(spark, t)
    SS.update(spark, t, compact=2)
    _same(spark, t, counts)
    IG.run_ingest(spark, S.delivery(f, S.RUN2_TS, include_late=True), t, S.RUN2_TS, "r2")
    SS.update(spark, t, compact=2)                                       # two shares: a base
    root = SS._root(t, SS.Options())
    assert SS._base(spark, t, root)[0] == 1
    kept = _same(spark, t, counts)
    read = kept.inputFiles()
    assert read and not any("/loads/" in x for x in read) and all("base=1" in x for x in read if "/suite/" in x)
    IG.run_ingest(spark, f.where("k % 50 = 0"), t, S.RUN2_TS + dt.timedelta(days=1), "r3")
    SS.update(spark, t, compact=2)
    assert not any("/loads/" in x or "run_id=r1" in x for x in _same(spark, t, counts).inputFiles())
    # a full reload hides the runs in the base: it no longer counts
    IG.run_ingest(spark, f, t, S.RUN3_TS, "r4", full_reload=True)
    SS.update(spark, t, compact=2)
    assert SS._base(spark, t, root)[0] is None
    _same(spark, t, counts)
    assert _rows(SS.state(spark, t)["counts"]) == _rows(C.staged_counts(IG.read_staging(spark, t)))


def test_a_share_that_was_not_finished_is_written_again(spark, sf_small, tmp_dir, monkeypatch):
    f, t = S.feeds(spark, sf_small), IG.Tables(f"{tmp_dir}/t")
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r1")
    with monkeypatch.context() as m:
        m.setattr(SS, "TABLES", ("counts", "facts"))
        SS.update(spark, t)
    SS.update(spark, t)
    _same(spark, t, C.source_counts(f))


def test_other_options_are_another_state(spark, sf_small, tmp_dir):
    f, t = S.feeds(spark, sf_small), IG.Tables(f"{tmp_dir}/t")
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r1")
    options = SS.Options(allowed_types=("GED",), allowed_statuses=("ACTIVE", "UNKNOWN"))
    SS.update(spark, t, options)
    staging = IG.read_staging(spark, t).select(*N.CANONICAL)
    kept = SS.results(C.source_counts(f), SS.state(spark, t, options), staging, options=options)
    want = RP.build_results(C.source_counts(f), staging, allowed_types=options.allowed_types, allowed_statuses=options.allowed_statuses)
    assert _rows(kept) == _rows(want)
    with pytest.raises(ValueError):
        SS.state(spark, t)


def test_empty_staging(spark, tmp_dir, sf_small):
    t = IG.Tables(f"{tmp_dir}/t")
    IG.run_ingest(spark, S.feeds(spark, sf_small).limit(0), t, S.RUN1_TS, "r1")
    SS.update(spark, t)
    _same(spark, t, spark.createDataFrame([("a.csv", "v1", 0)], "feed string, ver string, source_count long"))


# ----------------------------------------------------------------------------- AGG-8..10
def _plain_profile(staging):
    rows = {}
    for r in staging.collect():
        rows.setdefault(r.student_id, []).append(r)
    return sorted(repr((k, *[len({x[c] for x in v if x[c] is not None}) > 1 for c in C.PROFILE])) for k, v in rows.items())


@pytest.mark.parametrize("bits", [64, 1, 3])
def test_profile_is_exact_also_when_hashes_collide(spark, sf_small, bits):
    st = S.staging(spark, sf_small).withColumn("school_id", F.when(F.col("school_id") < "DIST004", None).otherwise(F.col("school_id")))
    got = C.student_profile(st, bits=bits)
    assert sorted(repr(tuple(r)) for r in got.collect()) == _plain_profile(st)
    if bits == 1:
        assert C.colliding_values(C.profile_values(st), 1).count() > 2


def test_kept_state_is_exact_also_when_hashes_collide(spark, sf_small, tmp_dir):
    f, t, options = S.feeds(spark, sf_small), IG.Tables(f"{tmp_dir}/t"), SS.Options(bits=2)
    IG.run_ingest(spark, f, t, S.RUN2_TS, "r1")
    SS.update(spark, t, options)
    _same(spark, t, C.source_counts(f), options)


def test_profile_is_a_hash_aggregate(spark, sf_small):
    tree = plan_text(C.student_hashes(S.staging(spark, sf_small))).split("\n\n")[0]
    assert "HashAggregate" in tree and "SortAggregate" not in tree and "ObjectHash" not in tree
    assert tree.count("Exchange") == 1 and "Expand" not in tree


# ----------------------------------------------------------------------------- SNK-7, CHK-13
def test_saved_report_is_one_file_in_order(spark, sf_small, tmp_dir):
    results = RP.build_results(C.source_counts(S.feeds(spark, sf_small)), S.staging(spark, sf_small))
    lines = RP.render(results, "run-1", "2024-01-01 00:00:00 UTC")
    path = RP.report_file(f"{tmp_dir}/reports", dt.datetime(2024, 1, 2, 3, 4, 5))
    RP.save_report(lines, path)
    local = path[len("file:"):] if path.startswith("file:") else path
    assert os.path.basename(local) == "reconciliation_20240102_030405.txt"
    text = open(local, encoding="utf-8").read().splitlines()
    assert text == [r.line for r in lines.orderBy("line_no").collect()]
    assert text[2].endswith("RECONCILIATION REPORT") and text[-1] == "=" * 74
    RP.save_report(lines, path)                                          # saved again: replaced
    assert open(local, encoding="utf-8").read().splitlines() == text


def test_report_numbers_need_no_global_window(spark, tmp_dir):
    counts = spark.range(3000).select(F.format_string("f%05d.csv", "id").alias("feed"), F.lit("v1").alias("ver"), F.col("id").alias("source_count"))
    staging = spark.createDataFrame([], ", ".join(f"{c} {'date' if c == 'issue_date' else 'string'}" for c in N.CANONICAL))
    lines = RP.render(RP.build_results(counts, staging), "r", "t")
    rows = lines.orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(1, len(rows) + 1))
    files = [r.line for r in rows if "Row count: v1" in r.line]
    assert len(files) == 3000 and [x.split("(")[1] for x in files] == sorted(x.split("(")[1] for x in files)
    heads = [r.line for r in rows if r.line in (C.ROW, C.NULLS, C.INTEGRITY, C.DUPLICATES, C.CONSISTENCY)]
    assert heads == [C.ROW, C.NULLS, C.INTEGRITY, C.DUPLICATES, C.CONSISTENCY]


# ----------------------------------------------------------------------------- DOC-5
def test_a_publication_that_fails_leaves_the_layer_before(spark, tmp_dir, monkeypatch):
    ok = spark.createDataFrame([("PASS",)], "status string")
    layer = f"{tmp_dir}/gold"
    with pytest.raises(FileNotFoundError):
        RP.read_published(spark, layer)
    RP.publish_if_passed(ok, spark.range(3), layer, "v-1")
    assert RP.read_published(spark, layer).count() == 3
    broken = spark.range(8).select(F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        RP.publish_if_passed(ok, broken, layer, "v-2")
    assert RP.read_published(spark, layer).count() == 3 and RP.published_version(spark, layer) == "v-1"
    with monkeypatch.context() as m:
        m.setattr(RP, "_point", lambda *a: (_ for _ in ()).throw(OSError("driver gone")))
        with pytest.raises(OSError):
            RP.publish_if_passed(ok, spark.range(9), layer, "v-2")
    assert RP.read_published(spark, layer).count() == 3
    RP.publish_if_passed(ok, spark.range(9), layer, "v-2")
    assert RP.read_published(spark, layer).count() == 9
    with pytest.raises(RP.GateFailed):
        RP.publish_if_passed(spark.createDataFrame([("FAIL",)], "status string"), spark.range(1), layer, "v-3")
    assert RP.published_version(spark, layer) == "v-2"
