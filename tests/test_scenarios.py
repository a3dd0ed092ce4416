"""Prepared tables follow their input files."""

import shutil
import time

import pyarrow.parquet as pq

from feedrecon.layouts import LAYOUTS
from feedrecon.operators import ingest as IG
from feedrecon.plans import catalog as CAT
from feedrecon.plans import scenarios as S
from feedrecon.sources import csv_feeds as CSV


def test_changed_input_is_prepared_anew(spark, sf_small, tmp_path):
    for t in ("orders", "customer"):
        shutil.copyfile(f"{sf_small}/{t}.parquet", tmp_path / f"{t}.parquet")      # the data may be read-only
    d = str(tmp_path)
    a, n = S.prepared_key(spark, d), S.feeds(spark, d).count()
    assert S.prepared_key(spark, d) == a
    time.sleep(1.1)
    pq.write_table(pq.read_table(f"{sf_small}/orders.parquet").slice(0, 50), tmp_path / "orders.parquet")
    assert S.prepared_key(spark, d) != a
    assert 0 < S.feeds(spark, d).count() < n


def test_rejected_target_takes_every_layout(spark, sf_small):
    target = S.rejected_target(spark, sf_small)
    assert IG.read_staging(spark, target).count() == 0
    rejected = {r.source_schema_version: r["count"]
                for r in IG.read_quarantine(spark, target).groupBy("source_schema_version").count().collect()}
    assert rejected == {r.ver: r["count"] for r in S.full_extract(S.feeds(spark, sf_small)).groupBy("ver").count().collect()}


def test_line_breaks_pass_through_every_layout(spark, sf_small):
    d = CAT.multiline_all_feeds(spark, sf_small)
    names = {}
    for r in CSV.classify_directory(spark, d).collect():
        folder, name = r.feed.split("/")
        assert name.startswith(f"{r.version}_")
        names.setdefault(folder, set()).add(name)
    assert names["s1"] == names["s2"] and {n[:2] for n in names["s1"]} == set(LAYOUTS)
    back = CAT.csv_multiline_roundtrip_all(spark, sf_small)
    st = S.staging(spark, sf_small)
    assert back.where("contains(school_id, '\\nEast')").groupBy("source_schema_version").count().exceptAll(
        st.groupBy("source_schema_version").count()).count() == 0
    assert back.count() == st.count() > 0


def test_files_grow_with_the_rows(spark, sf_small, monkeypatch):
    monkeypatch.setattr(CAT, "FILE_ROWS", 40)
    rows = {r.source_schema_version: r["count"] for r in S.staging(spark, sf_small).groupBy("source_schema_version").count().collect()}
    counts = CAT.folder_row_counts_all(spark, sf_small).collect()
    assert sum(r.source_count for r in counts) == sum(rows.values())
    for folder in ("s1", "s2"):
        names = {r.feed for r in counts if r.feed.startswith(folder)}
        assert names == {f"{folder}/{v}_{i}.csv" for v, n in rows.items() for i in range(4 + n // 40)}
