"""Every registered query with SQL against DuckDB."""

import duckdb
import pytest

from feedrecon.llm.registry import ORACLE, REGISTRY
from feedrecon.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = REGISTRY[name](spark, sf_small)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    rnd = lambda x: round(x, 6) if isinstance(x, float) else x
    got = sorted(repr([rnd(r[c]) for c in cols]) for r in df.collect())
    assert got == sorted(repr([rnd(x) for x in r]) for r in cur.fetchall())
