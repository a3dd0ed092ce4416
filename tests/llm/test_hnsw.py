"""HNSW near-dedup against brute force."""

import numpy as np
import pytest

from feedrecon.llm import hnsw as H


def clusters(seed, n=1500, d=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for size in (2, 2, 3, 5, 40, 300):          # near copies of one vector
        at = rng.choice(n, size, replace=False)
        x[at] = x[at[0]] + 0.15 * rng.standard_normal((size, d))
    return x.astype(np.float32)


def brute(rows, threshold=0.9):
    ids = [r[0] for r in rows]
    ok = [r[1] is not None and len(r[1]) > 0 and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1]) for r in rows]
    n, comp = len(rows), list(range(len(rows)))
    dims = [len(r[1]) if o else -1 for r, o in zip(rows, ok, strict=True)]
    links = np.zeros((n, n), bool)
    for d in set(dims) - {-1}:
        at = [i for i in range(n) if dims[i] == d]
        u = H.unit(np.array([rows[i][1] for i in at], dtype=np.float64))
        links[np.ix_(at, at)] = u @ u.T >= threshold
    np.fill_diagonal(links, False)
    while True:
        new = [min([comp[i], *[comp[j] for j in np.flatnonzero(links[i])]]) for i in range(n)]
        if new == comp:
            break
        comp = new
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[comp[i]] = min(least.get(comp[i], ids[i]), ids[i])
    return {(ids[i], int(links[i].sum()), least.get(comp[i]), ids[i] is not None and ids[i] == least.get(comp[i])) for i in range(n)}


@pytest.mark.parametrize("seed", [0, 1])
def test_recall_of_links_and_exact_components(seed):
    x = H.unit(clusters(seed))
    g = H.audit(H.build_graph(x.astype(np.float32)), 0.9, 0)
    a, b = g.close(x.astype(np.float32), 0.9 - H.SLACK, g.beam)
    found = {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if x[i] @ x[j] >= 0.9}
    true = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.9)), strict=True))
    assert found <= true and len(found) >= 0.97 * len(true)


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    x = clusters(3, 700)
    rows = [(int(i * 3 + 1), [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(5000, rows[0][1]), (5001, rows[0][1]), (5001, rows[0][1]), (5002, [2 * c for c in rows[1][1]]), (5003, None),
             (5004, []), (5005, [0.0] * 24), (5006, [float("nan")] + [1.0] * 23), (5007, [None] + [1.0] * 23),
             (5008, [float("inf")] + [1.0] * 23), (5009, [1.0, 2.0]), (5010, [2.0, 4.0]), (None, rows[2][1]), (None, [1.0, -3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, node string")
    got = {tuple(r) for r in H.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()}
    assert got == brute([(i, None if v is None else [None if c is None else np.float32(c) for c in v]) for i, v in rows])


def near(v, seed):
    return [float(np.float32(c)) for c in np.array(v) + 0.02 * np.random.default_rng(seed).standard_normal(len(v))]


@pytest.mark.parametrize("ids", [(7, 7, 9, 10), (7, 9, 7, 10), (7, 7, 7, 7), (None, 7, None, 7)])
def test_repeated_ids_name_no_vector(spark, ids):
    """Rows that share an id but not a vector: a, a', b, b' under every grouping of ids."""
    rng = np.random.default_rng(2)
    a, b = ([float(np.float32(c)) for c in rng.standard_normal(16)] for _ in range(2))
    rows = list(zip(ids, [a, near(a, 1), b, near(b, 2)], strict=True)) + [(1, [float(i) for i in range(16)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in H.near_duplicates(df).drop("vec_id").collect())
    assert [r[0] for r in got] == [0, 1, 1, 1, 1] or sorted(r[0] for r in got) == [0, 1, 1, 1, 1]
    assert {tuple(r) for r in H.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()} == brute(rows)


def test_links_are_counted_at_both_ends_in_slices(spark, monkeypatch):
    """A chain and a dense group over many slices; lengths mixed in one batch."""
    monkeypatch.setattr(H, "SLICE", 7)
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in [np.cos(0.3 * i), np.sin(0.3 * i)]]) for i in range(60)]
    centre = rng.standard_normal(5)
    rows += [(100 + i, [float(np.float32(c)) for c in centre + 0.05 * rng.standard_normal(5)]) for i in range(50)] + [(160, rows[3][1]), (161, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in H.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()} == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert H.near_duplicates(df).count() == 0


def test_beam_widens_past_a_large_group():
    rng = np.random.default_rng(4)
    x = H.unit(np.concatenate([rng.standard_normal(16) + 0.05 * rng.standard_normal((900, 16)), rng.standard_normal((300, 16))]))
    g = H.build_graph(x.astype(np.float32))
    g.beam = 16
    a, _ = g.close(x[:5].astype(np.float32), 0.9, 16)
    assert (np.bincount(a, minlength=5) >= 0.97 * (x[:5] @ x.T >= 0.9).sum(axis=1)).all()


class Losing:
    """A graph whose narrow beams find a vector itself and its ``hot`` group, and lose all other links."""

    def __init__(self, x, hot):
        self.x, self.hot, self.beam = x, hot, H.FIRST_BEAM

    def close(self, q, least, beam):
        s = q @ self.x.T
        a, b = np.nonzero(s >= least)
        keep = (s[a, b] == s.max(axis=1)[a]) | ((a >= 0) & (b < self.hot)) | (beam >= 64)
        return a[keep], b[keep]


@pytest.mark.parametrize("hot", [0, 300])
def test_audit_sees_few_links_beside_self_matches_and_a_hot_group(hot):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1000, 48))
    x[:hot] = rng.standard_normal(48) + 0.02 * rng.standard_normal((hot, 48))
    pairs = np.arange(400, 424).reshape(-1, 2)
    x[pairs[:, 1]] = x[pairs[:, 0]] + 0.05 * rng.standard_normal((len(pairs), 48))
    g = H.audit(Losing(H.unit(x).astype(np.float32), hot), 0.9, 0)
    assert g.beam >= 64


def test_recall_of_the_query_on_shards_answered_by_the_graph(spark):
    n, d = 8000, 24
    rng = np.random.default_rng(9)
    x = rng.standard_normal((n, d))
    for at in np.split(rng.permutation(n)[:3000], 1000):                  # 1000 groups of three
        x[at[1:]] = x[at[0]] + 0.2 * rng.standard_normal((2, d))
    x = x.astype(np.float32)
    u = H.unit(x)
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = H.near_duplicates(df).collect()
    sizes = {}
    for r in out:
        sizes[r.component_id] = sizes.get(r.component_id, 0) + 1
    assert all((r.n_links > 0) == (sizes[r.component_id] > 1) for r in out)          # a link shows at both its ends
    got = {r.vec_id: r.n_links for r in out}
    got = np.array([got[i] for i in range(n)])
    print(f"links {got.sum()} of {want.sum()}, recall per linked vector {(got[want > 0] / want[want > 0]).mean():.4f}")
    assert (got <= want).all() and (got[want > 0] / want[want > 0]).mean() >= 0.97
