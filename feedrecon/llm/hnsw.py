"""Embedding near-dedup with hierarchical navigable small-world graphs.

1. Equal vectors are one node (with its multiplicity), known by a running number, from here on.
2. Nodes are dealt into shards of bounded size by hash; each task builds one
   shard's graph: levels by a geometric draw, links chosen by the diversity
   rule, both ways, pruned to a bounded degree. Points enter in small batches whose beams
   run together (arrays, not a Python loop per vector).
3. **Recall audits** set a shard's beam: sampled vectors are turned away to just the
   link threshold and searched for, and sampled vectors' true neighbours in the
   shard (brute force) must be found. The beam doubles until both recalls reach
   ``AUDIT_RECALL`` (at the latest when it covers the shard).
4. Every block of nodes queries every shard. A query whose beam ends full of
   links is widened further, so a group larger than the beam is found whole.
5. Candidates are verified by cosine in double precision, and only a spanning forest of a task's
   links leaves it: the rows that are shuffled grow with the vectors, not with the pairs.
6. Connected components of the links.
7. **Counts**: linked vectors are in one component, so within each component all cosines are taken
   (in double precision, in slices of bounded size) and every link is counted at both its ends,
   whichever end's search had met it.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.llm.components import connected_components
from feedrecon.llm.simhash import forest
from feedrecon.llm.util import numbered, stored

THRESHOLD = 0.9
#: Links kept per node on the upper levels; twice as many on the lowest.
DEGREE = 12
BUILD_BEAM, FIRST_BEAM = 48, 16
#: Vectors a shard holds at most (about), queries of one task (about).
SHARD, BLOCK = 32_768, 16_384
#: Shards of a small table: up to so many, of so many vectors at least.
SOME_SHARDS, LEAST = 4, 2_048
#: Vectors of a slice of a component.
SLICE = 2_048
AUDITS, AUDIT_RECALL = 256, 0.97
#: Candidates are taken from a little below the threshold in single precision, then verified.
SLACK = 1e-4
_AT_ONCE, _EXPAND = 256, 4
#: A beam of this part of a shard is replaced by the whole shard; pairs verified at once.
ALL, VERIFY = 8, 1 << 17


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def beam_search(x, links, q, entry, beam, hits=None, least=np.inf):
    """The ``beam`` nearest nodes found for each query: (ids, similarities),
    nearest first, -1 where there are fewer. Nodes met with at least ``least``
    are appended to ``hits`` as (query rows, ids)."""
    m, n = len(q), len(links)
    ids = np.full((m, beam), -1, np.int64)
    sims = np.full((m, beam), -np.inf, np.float32)
    open_ = np.zeros((m, beam), bool)
    seen = np.zeros((m, n), bool)
    rows = np.arange(m)
    ids[:, 0], sims[:, 0], open_[:, 0] = entry, np.einsum("md,md->m", q, x[entry]), True
    seen[rows, entry] = True
    if hits is not None:
        at = np.flatnonzero(sims[:, 0] >= least)
        hits.append((at, ids[at, 0]))
    live = rows
    width = min(_EXPAND, beam)
    while len(live):
        waiting = np.where(open_[live], sims[live], -np.inf)
        live_now = waiting.max(axis=1) > -np.inf
        live, waiting = live[live_now], waiting[live_now]
        if not len(live):
            break
        pick = np.argpartition(-waiting, width - 1, axis=1)[:, :width] if width < beam else np.tile(np.arange(beam), (len(live), 1))
        usable = np.take_along_axis(waiting, pick, 1) > -np.inf
        open_[live[:, None], pick] &= ~usable
        near = links[ids[live[:, None], pick]]
        near = np.where(usable[:, :, None], near, -1).reshape(len(live), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], near]
        a, b = np.nonzero(fresh)
        node = near[a, b]
        seen[live[a], node] = True
        sim = np.full(near.shape, -np.inf, np.float32)
        sim[a, b] = s = np.einsum("kd,kd->k", x[node], q[live[a]])
        if hits is not None:
            close = s >= least
            hits.append((live[a[close]], node[close]))
        all_s = np.concatenate([sims[live], sim], axis=1)
        keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        sims[live] = np.take_along_axis(all_s, keep, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), keep, 1)
        open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh], axis=1), keep, 1)
    ids[np.isneginf(sims)] = -1
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def choose_links(x, ids, sims, degree):
    """Diversity rule: of the candidates (nearest first) one is linked if it is
    nearer to the node than to every one linked before; free places go to the nearest left."""
    v = x[ids]
    between = np.matmul(v, v.transpose(0, 2, 1))
    m, n = ids.shape
    taken, missing = np.zeros((m, n), bool), ids < 0
    nearest = np.full((m, n), -np.inf, np.float32)      # of each candidate to the ones taken
    for c in range(n):
        taken[:, c] = ~missing[:, c] & (sims[:, c] > nearest[:, c]) & (taken.sum(axis=1) < degree)
        np.maximum(nearest, np.where(taken[:, c, None], between[:, :, c], -np.inf), out=nearest)
    place = np.where(taken, 0, n) + np.arange(n) + np.where(missing, 3 * n, 0)
    order = np.argsort(place, axis=1)[:, :degree]
    out = np.take_along_axis(np.where(missing, -1, ids), order, 1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def _link_back(x, links, new, chosen):
    """Add each new node to the lists of those it chose; full lists are chosen anew."""
    degree = links.shape[1]
    q, t = np.repeat(new, chosen.shape[1]), chosen.ravel()
    q, t = q[t >= 0], t[t >= 0]
    sim = np.einsum("kd,kd->k", x[q], x[t])
    order = np.lexsort((-sim, t))
    q, t = q[order], t[order]
    targets, start, count = np.unique(t, return_index=True, return_counts=True)
    place = np.arange(len(t)) - np.repeat(start, count)
    extra = np.full((len(targets), degree), -1, np.int64)
    fits = place < degree
    extra[np.repeat(np.arange(len(targets)), count)[fits], place[fits]] = q[fits]
    both = np.concatenate([links[targets], extra], axis=1)
    size = (both >= 0).sum(axis=1)
    order = np.argsort(both < 0, axis=1, kind="stable")
    packed = np.take_along_axis(both, order, 1)
    easy = size <= degree
    links[targets[easy]] = packed[easy][:, :degree]
    for part in np.array_split(np.flatnonzero(~easy), max(1, (~easy).sum() // 512)):
        if len(part):
            cand = packed[part]
            s = np.einsum("kcd,kd->kc", x[cand], x[targets[part]])
            s[cand < 0] = -np.inf
            near = np.argsort(-s, axis=1, kind="stable")
            links[targets[part]] = choose_links(x, np.take_along_axis(cand, near, 1), np.take_along_axis(s, near, 1), degree)


class Graph:
    """A shard's graph. Points are ordered by level, highest first, so every
    level holds a prefix of them; ``levels[0]`` is the lowest."""

    def __init__(self, x, levels, beam):
        self.x, self.levels, self.beam = x, levels, beam

    def descend(self, q, down_to):
        """The nearest node found above level ``down_to``, by narrow beams."""
        entry = np.zeros(len(q), np.int64)
        for links in self.levels[:down_to:-1]:
            entry = beam_search(self.x, links, q, entry, 4)[0][:, 0]
        return entry

    def close(self, q, least, beam):
        """(query rows, ids) of the nodes found with at least ``least``; queries
        whose beam ends full of such nodes are searched again with a wider one,
        and from an ``ALL``-th of the shard on with all of it."""
        found, rows = [], np.arange(len(q))
        while len(rows):
            if beam * ALL >= len(self.x):       # such a beam costs more than the whole shard
                s = q[rows] @ self.x.T
                a, b = np.nonzero(s >= least)
                found.append((rows[a], b))
                break
            hits: list = []
            sims = beam_search(self.x, self.levels[0], q[rows], self.descend(q[rows], 0), beam, hits, least)[1]
            full = sims[:, -1] >= least
            a, b = (np.concatenate(c) for c in zip(*hits, strict=True))
            done = ~full[a]
            found.append((rows[a[done]], b[done]))
            rows, beam = rows[full], beam * 4
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (rows, rows)


def level_sizes(n, degree):
    """How many points each level holds: every level a ``degree``-th of the one below
    (the geometric draw's expectation; the points' order is random, so a level is a random sample)."""
    sizes = [n]
    while sizes[-1] > degree:
        sizes.append(max(1, sizes[-1] // degree))
    return sizes


def build_graph(x, degree=DEGREE):
    """The graph over unit vectors in random order."""
    sizes = level_sizes(len(x), degree)
    graph = Graph(x, [None] * len(sizes), FIRST_BEAM)
    for level in range(len(sizes) - 1, -1, -1):
        width = 2 * degree if level == 0 else degree
        links = np.full((sizes[level], width), -1, np.int64)
        graph.levels[level], at, step = links, 1, 32
        while at < sizes[level]:
            new = np.arange(at, min(at + step, sizes[level]))
            q = x[new]
            entry = graph.descend(q, level)
            entry = np.where(entry < at, entry, 0)
            ids, sims = beam_search(x, links[:at], q, entry, min(BUILD_BEAM, at))
            own = q @ q.T                                        # the batch's members see each other
            own[np.arange(len(new))[:, None] <= np.arange(len(new))] = -np.inf
            k = min(len(new), BUILD_BEAM)
            top = np.argpartition(-own, k - 1, axis=1)[:, :k]
            ids = np.concatenate([ids, np.where(np.isneginf(np.take_along_axis(own, top, 1)), -1, new[top])], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(own, top, 1)], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            chosen = choose_links(x, ids, sims, degree)
            links[new, :degree] = chosen
            _link_back(x, links, new, chosen)
            at, step = at + len(new), min(2 * step, _AT_ONCE)
    return graph


def audit(graph, threshold, seed):
    """Widen the beam until sampled vectors are found from just at the
    threshold, and the sampled vectors' true neighbours too: recall is the mean
    over the sampled vectors that have another neighbour, itself left out, so
    that neither self matches nor a hot group's pairs hide the links of the others."""
    rng, n = np.random.default_rng(seed), len(graph.x)
    at = rng.choice(n, min(AUDITS, n), replace=False)
    x = graph.x[at]
    away = rng.standard_normal(x.shape).astype(np.float32)
    away -= np.einsum("kd,kd->k", away, x)[:, None] * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-9)
    t = threshold + 1e-3
    turned = (t * x + np.sqrt(1 - t * t) * away).astype(np.float32)
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    ok = np.einsum("kd,kd->k", turned, x) >= threshold           # one-dimensional vectors cannot be turned
    true = x @ graph.x.T >= threshold
    true[np.arange(len(at)), at] = False
    linked = true.any(axis=1)
    while True:
        a, b = graph.close(turned, threshold - SLACK, graph.beam)
        met = np.zeros(len(at), bool)
        met[a[at[a] == b]] = True
        a, b = graph.close(x, threshold - SLACK, graph.beam)
        found = np.zeros_like(true)
        found[a, b] = True
        good = met[ok].mean() if ok.any() else 1.0
        near = ((found & true).sum(axis=1)[linked] / true.sum(axis=1)[linked]).mean() if linked.any() else 1.0
        if graph.beam >= n or (good >= AUDIT_RECALL and near >= AUDIT_RECALL):
            return graph
        graph.beam *= 2


def _matrix(column) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = c.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(c), -1)


def _build(threshold):
    def build(t: pa.Table) -> pa.Table:
        shard, node = t.column("shard")[0].as_py(), t.column("node").to_numpy()
        order = np.random.default_rng(shard).permutation(len(node))     # a random order draws the levels
        v = _matrix(t.column("v"))[order]
        graph = audit(build_graph(unit(v).astype(np.float32)), threshold, shard)
        blob = io.BytesIO()
        np.savez(blob, v=v, node=node[order], beam=graph.beam,
                 **{f"level{i}": links.astype(np.int32) for i, links in enumerate(graph.levels)})
        return pa.table({"dim": [t.column("dim")[0].as_py()], "shard": [shard], "graph": pa.array([blob.getvalue()], pa.binary()),
                         "beam": pa.array([graph.beam], pa.int32())},
                        schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("graph", pa.binary()), ("beam", pa.int32())]))

    return build


def _query(threshold):
    def query(queries: pa.Table, graphs: pa.Table) -> pa.Table:
        out = {"node": [], "root": []}
        if queries.num_rows and graphs.num_rows:
            with np.load(io.BytesIO(graphs.column("graph")[0].as_py())) as g:
                u, node = unit(g["v"]), g["node"]
                levels = [g[f"level{i}"].astype(np.int64) for i in range(sum(k.startswith("level") for k in g))]
                graph = Graph(u.astype(np.float32), levels, int(g["beam"]))
            mine, v = queries.column("node").to_numpy(), unit(_matrix(queries.column("v")))
            names, place = np.unique(np.concatenate([mine, node]), return_inverse=True)
            group = np.arange(len(names))
            for at in range(0, len(mine), _AT_ONCE):
                a, b = graph.close(v[at:at + _AT_ONCE].astype(np.float32), threshold - SLACK, graph.beam)
                a = a + at
                for part in range(0, len(a), VERIFY):           # however many links there are, few are held at once
                    x, y = a[part:part + VERIFY], b[part:part + VERIFY]
                    real = (np.einsum("kd,kd->k", v[x], u[y]) >= threshold) & (mine[x] != node[y])
                    x, y = x[real], y[real]
                    child, root = forest(group[place[:len(mine)][x]], group[place[len(mine):][y]], len(names))
                    group[child] = root
                    group = group[group]
            child = np.flatnonzero(group != np.arange(len(names)))
            root = group[child]
            out = {"node": names[child], "root": names[root]}
        return pa.table({k: pa.array(c, pa.int64()) for k, c in out.items()})

    return query


def usable(v: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & whole & F.exists(v, lambda x: x != 0), F.lit(False))


def near_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, root`` from ``node, v`` (distinct usable vectors): spanning
    forests of the links that the graphs' searches met and the cosine confirmed."""
    total = vectors.count()
    shards, blocks = max(1, min(SOME_SHARDS, total // LEAST), -(-total // SHARD)), max(1, -(-total // BLOCK))
    v = vectors.withColumn("dim", F.size("v"))
    graphs = stored(v.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))
                    .groupBy("dim", "shard").applyInArrow(_build(threshold), "dim int, shard int, graph binary, beam int"), "graphs")
    block = F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(blocks)).cast("int")
    queries = (v.select("dim", "node", "v", block.alias("block"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    stock = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return (queries.groupBy("dim", "shard", "block").cogroup(stock.groupBy("dim", "shard", "block"))
            .applyInArrow(_query(threshold), "node long, root long"))


def _counted(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """``node, n``: linked rows among each pair of slices, from batches sorted by (component, lo, hi)."""
    def emit(keys, side, node, copies, v):
        (_, lo, hi), u = keys[0], unit(v)
        a = np.flatnonzero(side == lo)
        b = a if lo == hi else np.flatnonzero(side == hi)
        n = np.zeros(len(node), np.int64)
        for at in range(0, len(a), 512):
            rows = a[at:at + 512]
            close = (u[rows] @ u[b].T) >= threshold
            if lo == hi:
                close[np.arange(len(rows)), np.arange(at, at + len(rows))] = False       # not with itself
            n[rows] += close @ copies[b]
            if lo != hi:
                n[b] += copies[rows] @ close
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n)], names=["node", "n"])

    held: list[tuple] = []

    def whole():
        return emit(*[np.concatenate(x) for x in zip(*held, strict=True)])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("component", "lo", "hi")], 1)
        rest = [batch.column(c).to_numpy() for c in ("side", "node", "copies")]
        v = _matrix_of(batch.column("v"))
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if held and (held[-1][0][0] != keys[lo]).any():
                yield whole()
                held = []
            held.append((keys[lo:hi], *[r[lo:hi] for r in rest], v[lo:hi]))
    if held:
        yield whole()


def _matrix_of(column: pa.Array):
    """Rows of one length as a matrix; of several lengths (components never mix them) as an array of arrays."""
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == sizes[0]).all():
        return flat.reshape(len(column), -1)
    return _Rows(flat, np.concatenate(([0], np.cumsum(sizes))))


class _Rows:
    """Slices of rows of equal length out of rows of different ones."""
    def __init__(self, flat, at):
        self.flat, self.at = flat, at

    def __getitem__(self, rows: slice):
        lo, hi, _ = rows.indices(len(self.at) - 1)
        return self.flat[self.at[lo]:self.at[hi]].reshape(hi - lo, -1)


def link_counts(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, n`` from ``node, component, copies, v``: per node the rows of other nodes of its component
    with a cosine of at least ``threshold``. Components are cut into slices; each pair of slices is a group of its own, so
    no task holds a large component."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    slices = F.ceil(F.col("size") / F.lit(SLICE)).cast("int")
    dealt = (members.join(sizes, "component").withColumn("slices", slices)
             .withColumn("side", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
             .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")))
    rows = (dealt.select("component", "lo", "hi", "side", "node", "copies", "v").repartition("component", "lo", "hi")
            .sortWithinPartitions("component", "lo", "hi"))
    return rows.mapInArrow(lambda b: _counted(b, threshold), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: ``vec_id, n_links`` (other rows linked
    directly, equal vectors included), ``component_id`` (smallest vec_id
    reachable) and ``kept``.

    Unusable vectors (null, empty, zero, or with null or non-finite
    components) link with nothing: no links, their own component, kept. Vectors
    of different length never link. A null id is never a component's id
    (null if there is no other, and then not kept); repeated rows are rows of
    their own and link with each other; an empty table gives an empty result."""
    v = F.col(f"`{vector}`")
    rows = stored(df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v"), usable(v).alias("usable"))
                  .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(7), "v")), "vectors")
    nodes = numbered(rows.where("usable").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), ["h1", "h2"], tag="vector-nodes")
    nodes = nodes.withColumnRenamed("pos", "node")
    links = stored(near_links(nodes.select("node", "v"), threshold), "vector-links")
    found = stored(connected_components(links, "node", "root").withColumnRenamed("node", "member"), "vector-components")
    members = nodes.join(found, F.col("node") == F.col("member"))
    counts = stored(link_counts(members.select("node", "component", "copies", "v"), threshold).withColumnRenamed("node", "counted"), "link-counts")
    firsts = members.groupBy("component").agg(F.min("least").alias("first"))
    ids = (nodes.select("h1", "h2", "node", "least", "copies")
           .join(found, F.col("node") == F.col("member"), "left").join(counts, F.col("node") == F.col("counted"), "left")
           .join(firsts, "component", "left")
           .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                   F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("first")).alias("component")))
    out = rows.where("usable").join(ids, ["h1", "h2"]).select("vec_id", F.col("n").alias("n_links"),
                                                              F.col("component").alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
