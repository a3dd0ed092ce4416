r"""SimHash near-dedup with pivot distance tables.

1. **Fingerprints**: XXH64 of every word shingle of the whole text; a bit is set
   if it is set in over half of them. Arrow-batched, one document at a time.
   Equal fingerprints are one node from here on.
2. **Pivot distance table**: the Hamming distances of every fingerprint to
   ``PIVOTS`` fixed reference fingerprints, computed once with built-in bit
   counts and carried as packed bytes. By the triangle inequality a pair whose
   distances to any one reference differ by more than ``max_bits`` is farther apart
   than that: it is discarded by its largest coordinate difference.
3. **Which pairs meet**: distances to random references lie too close together to
   serve as a join key, and comparing all pairs is out of the question. Distances to
   references that differ in one block's bits only fix that block's bits, so
   they are read as blocks: of ``blocks`` blocks at least ``blocks - max_bits`` are equal in
   any pair to be linked, so a pair meets under some choice of that many
   equal blocks (with 6 blocks and 3 bits: 20 keys of about 32 bits). Exact: no
   link is lost.
4. **Verification**: the survivors' distance, by XOR and bit count. Of each group only
   a spanning forest of its links leaves the task, never all its pairs.
   Groups of over ``GROUP`` fingerprints are cut into chunks that meet pairwise
   in separate tasks, so no task holds one.
5. Connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.components import connected_components
from feedrecon.llm.util import boxed, field, release_memory, stored, unboxed

#: Fixed values of the fingerprint: hash seed and shingle length of the registered query.
SEED, SHINGLE, MAX_BITS = 42, 3, 3
PIVOTS, BLOCKS, GROUP = 16, 6, 4096
_CHUNK = 65536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text. A-Z are lower-cased and words end at
    ASCII white space; a text of fewer words than a shingle is one shingle; a
    null text or one without words has fingerprint 0."""
    from functools import partial

    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    grams = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[w] for w in words]
    h = partial(xxh64_intdigest, seed=SEED)
    n, counts = max(1, len(words) - shingle + 1), np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*grams, strict=False))
    for at in range(0, n, _CHUNK):
        part = np.fromiter(map(h, islice(shingles, min(_CHUNK, n - at))), "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th, fp``: id, hash of the text and fingerprint (signed 64-bit) of every row of ``df``."""
    @F.pandas_udf("long")
    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in texts), "<u8", len(texts)).view("<i8"))
        release_memory()

    body = F.col(f"`{text}`")
    return df.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(body).alias("th"), of_text(body).alias("fp"))


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints from a rule: the SplitMix64 sequence from 0, as signed integers."""
    out, mask = [], 2 ** 64 - 1
    for j in range(1, n + 1):
        z = (j * 0x9E3779B97F4A7C15) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        z ^= z >> 31
        out.append(z - 2 ** 64 if z >= 2 ** 63 else z)
    return out


def distance_table(fp: Column, references: list[int]) -> list[Column]:
    """The distances to the references, eight to a long, one byte each."""
    out = []
    for at in range(0, len(references), 8):
        packed = F.lit(0).cast("long")
        for j, r in enumerate(references[at:at + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(r))).cast("long"), 8 * j))
        out.append(packed.alias(f"t{at // 8}"))
    return out


def block_masks(blocks: int, equal: int) -> list[int]:
    """Bit masks (signed) of every choice of ``equal`` out of ``blocks`` nearly equal blocks."""
    edges = [round(64 * b / blocks) for b in range(blocks + 1)]
    each = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(each, equal)]
    return [m - 2 ** 64 if m >= 2 ** 63 else m for m in masks]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For links a-b among n rows: each row that is not its component's smallest, with that smallest."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rows = np.flatnonzero(label != np.arange(n))
    return rows, label[rows]


def links_in_groups(group: np.ndarray, fp: np.ndarray, tables: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of equal group (rows sorted by group, then by the first
    distance) at most ``max_bits`` apart. Neighbours at offset 1, 2, … are
    compared, all groups at once, while the first distances are close enough."""
    first = tables[:, 0]
    i, offset, left, right = np.arange(len(fp)), 1, [], []
    while len(i):
        i = i[i + offset < len(fp)]
        j = i + offset
        close = (group[i] == group[j]) & (first[j] - first[i] <= max_bits)
        i, j = i[close], j[close]
        near = np.abs(tables[i] - tables[j]).max(axis=1, initial=0) <= max_bits     # discarded by the pivot tables
        a, b = i[near], j[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits                          # verified
        left.append(a[near])
        right.append(b[near])
        offset += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (i, i)


def _scan(batches: Iterator[pa.RecordBatch], max_bits: int, n_pivots: int) -> Iterator[pa.RecordBatch]:
    """Links of whole groups from batches sorted by (choice, part, chunks, first distance)."""
    def columns(b):
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("choice", "part", "lo", "hi")], 1)
        packed = np.stack([b.column(f"t{k}").to_numpy(zero_copy_only=False) for k in range((n_pivots + 7) // 8)], 1)
        table = np.ascontiguousarray(packed.astype("<i8")).view(np.uint8).reshape(len(packed), -1)[:, :n_pivots].astype(np.int16)
        return keys, b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64), table

    def emit(keys, fp, table):
        group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1)))) if len(fp) else np.zeros(0, int)
        a, b = links_in_groups(group, fp.view(np.uint64), table, max_bits)
        rows, roots = forest(a, b, len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[rows]), pa.array(fp[roots])], names=["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = columns(batch)
        held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
        open_from = int(np.argmax((held[0] == held[0][-1]).all(axis=1)))    # the last group may go on
        if open_from:
            yield emit(*[x[:open_from] for x in held])
            held = tuple(x[open_from:] for x in held)
    if held is not None:
        yield emit(*held)


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, n_pivots: int = PIVOTS,
               group: int = GROUP) -> DataFrame:
    """``a, b``: links between the distinct fingerprints of ``fps`` (column
    ``fp``) at most ``max_bits`` apart, enough of them that every pair so linked
    is in one component."""
    references = pivots(n_pivots)
    tables = distance_table(F.col("fp"), references)
    masks = block_masks(blocks, blocks - max_bits)
    keys = F.array(*[F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
                     for c, m in enumerate(masks)])
    members = fps.select("fp", *tables, F.explode(keys).alias("k")).select("fp", *[f"t{k}" for k in range(len(tables))], "k.*")
    # a group over the bound is cut into chunks; each pair of chunks meets in a group of its own
    large = stored(fps.select(F.explode(keys).alias("k")).groupBy("k.choice", "k.part").agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > group), "large-groups")
    if large.isEmpty():
        dealt = members.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    else:
        chunks = F.coalesce(F.ceil(2 * F.col("n") / F.lit(group)), F.lit(1)).cast("int")
        dealt = (members.join(large, ["choice", "part"], "left").withColumn("chunks", chunks)
                 .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
                 .drop("n", "chunks", "mine", "other"))
    ordered = (dealt.repartition("choice", "part", "lo", "hi")
               .sortWithinPartitions("choice", "part", "lo", "hi", F.col("t0").bitwiseAND(F.lit(255))))
    return ordered.mapInArrow(lambda batches: _scan(batches, max_bits, n_pivots), "a long, b long")


def _groups(df: DataFrame, key: str, text: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, th, fp`` of every row (``th``: hash of the text), and ``node, component, first`` for every
    distinct fingerprint; ``first`` is the component's first document: smallest id, then text hash."""
    docs = stored(fingerprints(df, key, text, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th"))
    nodes = stored(docs.groupBy("fp").agg(first.alias("first")), "fingerprint-nodes")
    links = stored(near_links(nodes.select("fp"), max_bits), "fingerprint-links")
    found = stored(connected_components(links, "a", "b"), "fingerprint-groups")
    of_node = (nodes.join(found, nodes["fp"] == found["node"], "left")
               .select(F.col("fp").alias("node"), "first", F.coalesce("component", "fp").alias("component")))
    firsts = of_node.groupBy("component").agg(F.min("first").alias("first"))
    return docs, of_node.select("node", "component").join(firsts, "component")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fingerprint`` (16 lower-case hex
    digits) and ``component_id``, the smallest doc_id reachable by links of at
    most ``max_bits`` differing bits.

    Null and empty texts have fingerprint 0 and link like any other; null ids
    are never a component's id (null if it has no other); repeated rows stay; an
    empty table gives an empty result; other columns are not read."""
    docs, nodes = _groups(df, key, text, shingle, max_bits)
    ids = nodes.select("node", F.col("first.doc_id").alias("component_id"))
    return (docs.join(ids, docs["fp"] == ids["node"])
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one document of each group of near duplicates, all columns
    kept: the one with the smallest id (then the smallest text hash; a row
    without an id only if the group has no id). Of rows equal in id and text one stays."""
    docs, nodes = _groups(df, key, text, shingle, max_bits)
    kept = nodes.select(F.col("first.doc_id").alias("id"), F.col("first.th").alias("th")).distinct()
    name, th = field(df, key), F.xxhash64(field(df, text))
    rows = boxed(df).join(kept.hint("shuffle_hash"), name.eqNullSafe(F.col("id")) & (th == F.col("th")), "left_semi")
    if not docs.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        one = Window.partitionBy(name, th).orderBy(F.lit(0))
        rows = rows.withColumn("place", F.row_number().over(one)).where("place = 1")
    return unboxed(rows, df.columns)
