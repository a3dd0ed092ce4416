"""Dual-tree search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedrecon.llm import topk as T


def brute(queries, data, k):
    out = set()
    for qid, q in queries:
        if q is None or qid is None:
            continue
        s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i if i is not None else T.NULL_ID)
                   for i, v in data if v is not None and i != qid and len(v) == len(q))
        out |= {(qid, r + 1, None if i == T.NULL_ID else i, -int(x)) for r, (x, i) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_tree_invariants_and_search(spread):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((12, 8)) * 40
    x = np.floor(centres[rng.integers(0, 12, 900)] + spread * 20 * rng.standard_normal((900, 8)))
    ids = rng.permutation(900)
    t = T.build_tree(x, ids)
    for i in range(len(t.radius)):
        inside = t.x[t.lo[i]:t.hi[i]]
        assert np.sqrt(((inside - t.q[i]) ** 2).sum(1)).max() <= t.radius[i] + 1e-9
        if t.children[i]:
            below = range(t.child[i], t.child[i] + t.children[i])
            assert t.centre[below[0]] == t.centre[i] and [t.lo[i], *[t.hi[c] for c in below]] == [*[t.lo[c] for c in below], t.hi[i]]
    q = rng.choice(900, 100, replace=False)
    s = T.DualSearch(T.build_tree(x[q], ids[q]), t, 10).run()
    got = {(int(i), r + 1, int(v), int(z)) for i, vs, zs in zip(s.queries.ids, s.found, s.score, strict=True)
           for r, (v, z) in enumerate(zip(vs, zs, strict=True))}
    assert got == brute([(int(ids[i]), x[i].tolist()) for i in q], list(zip(ids.tolist(), x.tolist(), strict=True)), 10)
    if spread < 0.1:
        assert s.scored < 0.7 * 100 * 900        # node pairs were pruned


def test_top_k(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.integers(-3, 4, 6) / 8]) for i in range(200)]     # many ties
    rows += [(200, None), (201, [None] + [1.0] * 5), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, []),
             (205, [1.0, 2.0]), (60, rows[60][1]), (33, rows[33][1]), (None, rows[40][1]), (220, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, shard string")
    v = df.select(F.col("vec_id").alias("id"), T.scaled(F.col("embedding")).alias("v"))
    got = {tuple(r) for r in T.top_k(v.where("id % 20 = 0"), v, 15).collect()}
    plain = [(i, None if x is None or not x or any(c is None or not np.isfinite(c) for c in x) else
              [float(np.floor(64 * c)) for c in x]) for i, x in rows]
    queries = {i: x for i, x in plain if i is not None and i % 20 == 0}
    assert got == brute(queries.items(), plain, 15)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (3, [3.0])], "id long, v array<double>")
    assert T.top_k(df.where("id % 20 = 0"), df).count() == 4
    assert T.top_k(df.where("id < 0"), df).count() == 0
    assert T.top_k(df.where("id < 0"), df.where("id < 0")).count() == 0


def test_scores_beyond_double_precision_are_refused(spark):
    df = spark.createDataFrame([(0, [1e9, 1e9])], "id long, v array<double>")
    with pytest.raises(Exception, match="too large"):
        T.top_k(df, df).collect()
