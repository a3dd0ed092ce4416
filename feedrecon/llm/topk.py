"""Exact top-k inner products by dual-tree search on cover trees.

The data is dealt into shards of bounded size, each indexed by one cover tree;
the stated query set is dealt into blocks, each with a cover tree of its own. A
task joins one block's tree with one shard's tree: for query node Q and data node R with
centres q, r and covering radii a, b no pair scores more than
``<q, r> + a |r| + b |q| + a b``, nor more than the product of the largest norms
inside. Pairs of nodes whose bound is below the worst k-th score of Q's queries
are pruned; the others descend together, and leaves are scored as one matrix
product. Every shard's best k of a query meet in a final top k, so a query
sends at most k rows a shard.

A node has at most ``FAN`` children: the farthest-first walk that picks their
centres stops there even if some points are still farther than half the
radius. Radii are the true ones, so every bound holds.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.util import stored

K = 20
LEAF, FAN = 64, 32
#: Queries of a query tree's leaf, and data points scored at once, about.
QUERY_LEAF, AT_ONCE = 128, 1024
#: Vectors of a shard and queries of a block, about.
SHARD, MIN_SHARDS, BLOCK = 16_384, 4, 1024
#: Bounds are widened by this share before they prune: floating-point rounding can't lose a pair.
SLACK = 1e-9
NULL_ID = 2 ** 63 - 1
#: Sums up to here are exact in double precision.
EXACT = 2.0 ** 53


class CoverTree:
    """Nodes as arrays: centre (a row), covering radius, largest norm, rows
    ``lo:hi`` of the reordered points, first child and number of children."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, nodes: np.ndarray):
        self.x, self.ids = x, ids
        self.centre, self.lo, self.hi, self.child, self.children = nodes[:, :5].T.astype(np.int64)
        self.radius, self.norm = nodes[:, 5], nodes[:, 6]
        self.q = x[self.centre]                             # centres and their lengths
        self.length = np.sqrt((self.q * self.q).sum(axis=1))
        self.nodes = nodes

    def bounds(self, at: int, other: CoverTree, nodes: np.ndarray) -> np.ndarray:
        """No inner product between the points of node ``at`` and of the other tree's ``nodes`` exceeds these."""
        a, b = self.radius[at], other.radius[nodes]
        by_ball = other.q[nodes] @ self.q[at] + a * other.length[nodes] + b * self.length[at] + a * b
        most = np.minimum(by_ball, self.norm[at] * other.norm[nodes])
        return most + SLACK * (1 + self.norm[at] * other.norm[nodes])


def build_tree(x: np.ndarray, ids: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> CoverTree:
    """Top-down: a node's centre is its first child's centre; further children
    start at the farthest point until all points are within half the radius."""
    x = x.astype(np.float64)
    order, norms = np.arange(len(x)), np.sqrt((x * x).sum(axis=1))
    nodes, todo = [[0.0] * 7], [(0, len(x), 0, 0)] if len(x) else []     # rows lo:hi, centre point, node
    while todo:
        lo, hi, centre, me = todo.pop()
        points = order[lo:hi]
        d = np.sqrt(((x[points] - x[centre]) ** 2).sum(axis=1))
        radius = d.max()
        entry = [centre, lo, hi, 0, 0, radius, norms[points].max()]
        if hi - lo > leaf and radius > 0:
            best, nearest, centres = d.copy(), np.zeros(hi - lo, np.int64), [centre]
            while best.max() > radius / 2 and len(centres) < fan:
                far = points[int(best.argmax())]
                d = np.sqrt(((x[points] - x[far]) ** 2).sum(axis=1))
                closer = d < best
                nearest[closer], best[closer] = len(centres), d[closer]
                centres.append(far)
            by = np.argsort(nearest, kind="stable")
            order[lo:hi] = points[by]
            ends = lo + np.cumsum(np.bincount(nearest, minlength=len(centres)))
            entry[3], entry[4] = len(nodes), len(centres)
            for c, a, b in zip(centres, np.r_[lo, ends[:-1]], ends, strict=True):
                todo.append((int(a), int(b), int(c), len(nodes)))
                nodes.append([0.0] * 7)
        nodes[me] = entry
    nodes = np.array(nodes, dtype=np.float64)
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    if len(x):
        nodes[:, 0] = place[nodes[:, 0].astype(np.int64)]
    return CoverTree(x[order], ids[order], nodes)


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo:hi, one range after the other."""
    size = hi - lo
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())


class DualSearch:
    """Best ``k`` of the data tree for every point of the query tree."""

    def __init__(self, queries: CoverTree, data: CoverTree, k: int):
        self.queries, self.data, self.k = queries, data, k
        n = len(queries.x)
        self.score = np.full((n, k), -np.inf)
        self.found = np.full((n, k), NULL_ID, np.int64)
        self.scored = 0

    def worst(self, at: int) -> float:
        return self.score[self.queries.lo[at]:self.queries.hi[at], -1].min()

    def run(self) -> DualSearch:
        if len(self.queries.x) and len(self.data.x):
            self.visit(0, np.zeros(1, np.int64))
        return self

    def visit(self, at: int, nodes: np.ndarray) -> None:
        t, q = self.data, self.queries
        nodes = nodes[q.bounds(at, t, nodes) >= self.worst(at)]
        if not q.children[at]:
            self.leaf(at, nodes)
            return
        nodes = self.children_of(nodes)
        for child in range(q.child[at], q.child[at] + q.children[at]):
            self.visit(child, nodes)

    def children_of(self, nodes: np.ndarray) -> np.ndarray:
        """The nodes with every inner one replaced by its children."""
        t = self.data
        inner = t.children[nodes] > 0
        up = nodes[inner]
        return np.concatenate([nodes[~inner], ranges(t.child[up], t.child[up] + t.children[up])])

    def leaf(self, at: int, nodes: np.ndarray) -> None:
        """Descend to the data's leaves, then best bound first, until no bound reaches the worst k-th score."""
        t = self.data
        while (t.children[nodes] > 0).any():
            nodes = self.children_of(nodes)
            nodes = nodes[self.queries.bounds(at, t, nodes) >= self.worst(at)]
        bounds = self.queries.bounds(at, t, nodes)
        order = np.argsort(-bounds, kind="stable")
        nodes, bounds = nodes[order], bounds[order]
        ends = np.cumsum(t.hi[nodes] - t.lo[nodes])
        done, batch = 0, LEAF               # small batches first: they raise the worst score that prunes the rest
        while done < (left := np.searchsorted(-bounds, -self.worst(at), side="right")):
            scored = ends[done - 1] if done else 0
            upto = min(int(np.searchsorted(ends, scored + batch)) + 1, int(left))
            self.compare(at, ranges(t.lo[nodes[done:upto]], t.hi[nodes[done:upto]]))
            done, batch = upto, min(AT_ONCE, 2 * batch)

    def compare(self, at: int, rows: np.ndarray) -> None:
        """Score the data's ``rows`` against all queries of a leaf."""
        t, lo, hi = self.data, self.queries.lo[at], self.queries.hi[at]
        s = self.queries.x[lo:hi] @ t.x[rows].T
        self.scored += s.size
        s[self.queries.ids[lo:hi, None] == t.ids[rows]] = -np.inf       # not the query itself
        # merge what reaches a query's worst k-th score: few pairs once the best leaves were seen
        if s.shape[1] > 4 * self.k:
            s[s < np.partition(s, -self.k, axis=1)[:, -self.k, None]] = -np.inf      # ties with the k-th stay
        q, c = np.nonzero((s >= self.score[lo:hi, -1:]) & (s > -np.inf))
        if len(q):
            at_most, mine = np.arange(self.k), np.unique(q)
            query = np.concatenate([np.repeat(mine, self.k), q])
            score = np.concatenate([self.score[lo + mine].ravel(), s[q, c]])
            found = np.concatenate([self.found[lo + mine].ravel(), t.ids[rows[c]]])
            order = np.lexsort((found, -score, query))
            first = np.searchsorted(query[order], mine)
            best = order[first[:, None] + at_most]
            self.score[lo + mine], self.found[lo + mine] = score[best], found[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _build(t: pa.Table) -> pa.Table:
    x = _matrix(t.column("v"))
    if len(x) and (np.abs(x.astype(np.float64)).max() ** 2) * x.shape[1] >= EXACT:
        raise ValueError("components too large for exact scores in double precision")
    tree = build_tree(x, t.column("id").to_numpy())
    blob = io.BytesIO()
    small = np.abs(tree.x).max(initial=0) < 2 ** 31            # whole numbers: half the size in the shuffle
    np.savez(blob, x=tree.x.astype(np.int32) if small else tree.x, ids=tree.ids, nodes=tree.nodes)
    return pa.table({"dim": [t.column("dim")[0].as_py()], "shard": [t.column("shard")[0].as_py()], "tree": [blob.getvalue()]},
                    schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("tree", pa.binary())]))


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(queries: pa.Table, trees: pa.Table) -> pa.Table:
        if not queries.num_rows or not trees.num_rows:
            return schema.empty_table()
        with np.load(io.BytesIO(trees.column("tree")[0].as_py())) as t:
            data = CoverTree(t["x"].astype(np.float64), t["ids"], t["nodes"])
        asked = build_tree(_matrix(queries.column("v")), queries.column("id").to_numpy(), QUERY_LEAF)
        s = DualSearch(asked, data, k).run()
        real = s.score > -np.inf
        ids = np.broadcast_to(s.queries.ids[:, None], s.score.shape)
        return pa.table({"query_id": ids[real], "vec_id": s.found[real], "score": s.score[real].astype(np.int64)}, schema=schema)

    return search


def scaled(v: Column, factor: int = 64) -> Column:
    """Components as floor(factor * x), x as double; null for a vector that is
    null, empty, or holds a null or non-finite component."""
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce((F.size(v) > 0) & whole, F.lit(False)),
                  F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("double")))


def top_k(queries: DataFrame, data: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k``
    rows of ``data`` with the highest inner product (all, if fewer), ties to
    the smaller id. Both have ``id`` (long) and ``v`` (array of whole numbers as double).

    Rows with a null vector take no part, nor do queries without an id; data
    without an id ranks last in ties. A row never finds rows of its own id; a
    repeated query counts once, repeated data rows each rank; vectors of
    different length never meet; empty tables give an empty result. Raises
    where scores could exceed 2^53."""
    data = data.where("v IS NOT NULL").select(F.coalesce("id", F.lit(NULL_ID)).alias("id"), "v", F.size("v").alias("dim"))
    queries = queries.where("v IS NOT NULL AND id IS NOT NULL").select("id", "v", F.size("v").alias("dim")).dropDuplicates(["id"])
    shards = max(MIN_SHARDS, -(-data.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    trees = stored(data.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
                   .groupBy("dim", "shard").applyInArrow(_build, "dim int, shard int, tree binary"), "cover-trees")
    asked = (queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    stock = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (asked.groupBy("dim", "shard", "block").cogroup(stock.groupBy("dim", "shard", "block"))
             .applyInArrow(_search(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != NULL_ID, F.col("vec_id")).alias("vec_id"), "score"))
