"""Driver contract and a few oracle comparisons at the smallest scale."""

import duckdb

import __spark_entry__ as E
from feedrecon.sources.tables import TABLES


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    df = E.entry(spark)
    assert df.count() > 0 and "check_type" in df.columns


def test_some_oracles_match(spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    for name in ("normalise_all", "recon_results", "feed_classify", "ingest_two_runs", "export_v2"):
        df = E.queries()[name](spark, sf_small)
        got = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
        cur = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(repr(tuple(r[i] for i in order)) for r in cur.fetchall())
        assert got == want, name
