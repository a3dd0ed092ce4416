r"""Source divergence audit with late string materialization.

For every language and source, how its use of the language's kept terms differs from each other
source's and from the whole language's.

1. **Parts**: each task counts its texts' terms (occurrences and documents) per
   language and source and stores them with a 64-bit digest of each term: one
   row per group and distinct term of a bounded run of texts. Languages and groups are digests, too (a seed is
   taken under which no two of them share one).
2. **Shuffles carry digests only**: counts are summed by (group, digest) and by (language,
   digest), all fixed-width. The term column is not read.
3. **Collisions**: for digests that may be kept, the smallest and the largest term are
   found (the only strings that leave their tasks); where they differ the digest stands for several terms, its
   rows are split by the terms themselves (``sub``) and counted again.
4. **Pairs**: |p - q| summed over terms is, but for the terms that neither source has,
   a sum over stored rows. Blocks of terms (bounded in rows) become matrices of source x term,
   and each emits one partial sum per pair of sources, never a row per pair and term.
5. **Text comes back** for the few terms that are reported: first all ties at the last
   rank are kept by value, then their terms are joined and order the ties.

All numbers are whole: sums in 64 bits, the quotient in decimals of 38 digits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.util import release_memory, stored

MIN_DOCUMENTS, TOP, SCALE, SMOOTHING = 30, 50, 1_000_000_000, 5
#: Entries a task gathers before it emits them, and stored rows and empty cells a block of the pair sums holds at most.
HELD, BLOCK = 500_000, 100_000
#: Digests up to which the kept ones are broadcast to filter the terms (8 bytes each); beyond it an ordinary join does the same.
BROADCAST = 4_000_000
#: ASCII letters in lower case and all bytes of other characters; the rest are blanks.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GROUP, LANG = ["lid", "gid"], ["lid", "digest"]


def terms(text: str | None) -> list[bytes]:
    r"""The matches of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with only A-Z lower-cased, in UTF-8."""
    return text.encode().translate(_TABLE).split() if text else []


def _counts(batches: Iterator[pa.RecordBatch], bits: int, held: int) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh64_intdigest

    tallies: dict[tuple, tuple[Counter, Counter]] = {}
    entries = 0

    def emit():
        for (lid, gid), (n, docs) in tallies.items():
            words = list(n)
            digests = np.fromiter((xxh64_intdigest(w) for w in words), "<u8", len(words)) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), lid)), pa.array(np.full(len(words), gid)), pa.array(digests.view("<i8")),
                 pa.array(words, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([docs[w] for w in words], pa.int64())], names=["lid", "gid", "digest", "term", "n", "docs"])

    for batch in batches:
        columns = [batch.column(c) for c in ("lid", "gid", "text")]
        for lid, gid, text in zip(*[(x.as_py() for x in c) for c in columns], strict=True):
            n, docs = tallies.setdefault((lid, gid), (Counter(), Counter()))
            found = terms(text)
            entries -= len(n)
            n.update(found)
            docs.update(set(found))
            entries += len(n)
            if entries > held:
                yield from emit()
                tallies.clear()
                entries = 0
    yield from emit()
    release_memory()


def named_groups(df: DataFrame) -> tuple[DataFrame, int]:
    """``lang, source, lid, gid`` of every group that occurs, stored, and the seed under which no two languages and no two
    groups share a digest."""
    groups = stored(df.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        named = groups.select("*", *digests_of(seed))
        r = named.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("gid").alias("g"), F.count_distinct("lang").alias("l"), F.count_distinct("lid").alias("d")).first()
        if r.n == r.g and r.l == r.d:
            return named, seed
        seed += 1


def digests_of(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "lang").alias("lid"), F.xxhash64(F.lit(seed), "lang", "source").alias("gid")]


def parts(df: DataFrame, seed: int = 0, bits: int = 64, held: int = HELD) -> DataFrame:
    """``lid, gid, digest, term, n, docs``: per task counts, stored."""
    return stored(df.select(*digests_of(seed), "text").mapInArrow(
        lambda b: _counts(b, bits, held), "lid long, gid long, digest long, term string, n long, docs long"), "term-parts")


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (count + 5) / (total + 5 * kept))``, exactly."""
    def wide(c):
        return c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * wide(count + SMOOTHING)
    return F.call_function("div", top, F.nullif(wide(total + SMOOTHING * kept), F.lit(0).cast("decimal(20,0)"))) + 1


def kept_terms(found: DataFrame, min_documents: int) -> tuple[DataFrame, DataFrame]:
    """``lid, gid, digest, sub, n, n_lang`` of the kept terms of each language, and ``digest, sub, term``."""
    counts = stored(found.groupBy(*GROUP, "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                    .withColumn("sub", F.lit(0)), "term-counts")

    def enough(c, *k):
        return (c.groupBy("lid", *k).agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
                .where(F.col("docs") >= min_documents).drop("docs"))

    # documents of a digest are at least those of any of its terms: no term is lost here
    maybe = stored(enough(counts, "digest"), "kept-digests")
    wanted = maybe.select("digest").distinct()
    if maybe.count() <= BROADCAST:
        wanted = F.broadcast(wanted)
    names = stored(found.select("digest", "term").join(wanted, "digest", "left_semi")
                   .groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last")), "digest-terms")
    several = names.where("term <> last").select("digest")
    if several.isEmpty():
        return counts.select(*GROUP, "digest", "sub", "n").join(maybe, LANG), names.select("digest", F.lit(0).alias("sub"), "term")
    by_term = Window.partitionBy("digest").orderBy("term")              # the terms of one 64-bit digest
    split = stored(found.join(several, "digest", "left_semi").select("digest", "term").distinct()
                   .withColumn("sub", F.row_number().over(by_term)), "split-terms")
    again = (found.join(split, ["digest", "term"]).groupBy(*GROUP, "digest", "sub")
             .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    counts = counts.join(several, "digest", "left_anti").unionByName(again)
    names = names.join(several, "digest", "left_anti").select("digest", F.lit(0).alias("sub"), "term").unionByName(split.select("digest", "sub", "term"))
    counts = stored(counts, "term-counts-split")
    return counts.select(*GROUP, "digest", "sub", "n").join(enough(counts, "digest", "sub"), [*LANG, "sub"]), names


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one block: per pair of groups, |p - q| over its terms less |base - base| of each."""
    given = rows["base"].to_numpy(bool)
    base = rows[given].sort_values("gid")
    sources, floor = base["gid"].to_numpy(np.int64), base["p"].to_numpy(np.int64)
    rows = rows[~given]
    at = np.searchsorted(sources, rows["gid"].to_numpy(np.int64))
    term = rows.groupby(["digest", "sub"]).ngroup().to_numpy()
    width = int(term.max()) + 1 if len(term) else 0
    p = np.repeat(floor[:, None], width, axis=1)
    p[at, term] = rows["p"].to_numpy(np.int64)
    out = []
    for a in range(len(sources) - 1):
        d = np.zeros(len(sources) - a - 1, np.int64)
        for lo in range(0, width, 4096):
            d += np.abs(p[a + 1:, lo:lo + 4096] - p[a, lo:lo + 4096]).sum(axis=1)
        out.append(pd.DataFrame({"a": sources[a], "b": sources[a + 1:], "excess": d - width * np.abs(floor[a + 1:] - floor[a])}))
    out = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "excess": []})
    return out[["a", "b", "excess"]].astype(np.int64)


def divergence(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               min_documents: int = MIN_DOCUMENTS, top: int = TOP, bits: int = 64, held: int = HELD, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of the language by the
    distance of their term shares, part ``term`` the ``top`` terms a source uses more than its language.

    Null texts, languages and sources are empty ones; a group without terms
    has its rows of part ``pair``; a language with one source has none; without kept terms all values are 0;
    ties rank by item; repeated rows count as often as they stand; an empty table
    gives no rows; other columns are not read. ``bits`` of the digest are used (fewer, to test collisions)."""
    empty = F.lit("")
    rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    named, seed = named_groups(rows)
    live, names = kept_terms(parts(rows, seed, bits, held), min_documents)
    live = stored(live, "kept-counts")
    totals = live.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    of_lang = live.groupBy("lid", "digest", "sub").agg(F.first("n_lang").alias("n_lang")).groupBy("lid").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = (named.join(totals, GROUP, "left").join(of_lang, "lid", "left")
              .select("lang", "source", *GROUP, zero("total"), zero("kept"), zero("total_lang")))
    groups = stored(groups.withColumn("base", share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
                    .withColumn("base", zero("base")), "group-totals")
    scored = stored(live.join(groups.drop("lang", "source"), GROUP).select(
        *GROUP, "digest", "sub", share(F.col("n"), F.col("total"), F.col("kept")).cast("long").alias("p"),
        share(F.col("n_lang"), F.col("total_lang"), F.col("kept")).cast("long").alias("q"), "n"), "term-shares")
    name = groups.select(*GROUP, "lang", "source")

    # part term: by value first, then by text among what is left
    best = Window.partitionBy(*GROUP)
    near = (scored.where("n > 0 and p > q").withColumn("value", F.col("p") - F.col("q"))
            .withColumn("place", F.rank().over(best.orderBy(F.desc("value")))).where(F.col("place") <= top))
    out_term = (near.join(names, ["digest", "sub"]).select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value")
                .withColumn("rank", F.row_number().over(best.orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top))

    # part pair: partial sums per block of terms
    blocks = (groups.groupBy("lid").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("sources"))
              .where("kept > 0 and sources > 1").select("lid", F.ceil(F.col("kept") * F.col("sources") / F.lit(block)).cast("int").alias("blocks")))
    dealt = (scored.join(blocks, "lid").withColumn("block", F.pmod(F.xxhash64("digest", "sub"), F.col("blocks")).cast("int"))
             .select(*GROUP, "block", "digest", "sub", "p", F.lit(False).alias("base")))
    floors = (groups.join(blocks, "lid").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(*GROUP, "block", F.lit(0).cast("long").alias("digest"), F.lit(0).alias("sub"), F.col("base").alias("p"), F.lit(True).alias("base")))
    sums = (dealt.unionByName(floors).groupBy("lid", "block").applyInPandas(_pair_sums, "a long, b long, excess long")
            .groupBy("a", "b").agg(F.sum("excess").alias("excess")))
    one = groups.select(*GROUP, "base", "kept")
    other = groups.select("lid", F.col("gid").alias("other"), F.col("source").alias("item"), F.col("base").alias("floor"))
    # one row per pair of sources of a language: the result itself
    pairs = (one.join(other, "lid").where("gid <> other").withColumn("a", F.least("gid", "other")).withColumn("b", F.greatest("gid", "other"))
             .join(sums, ["a", "b"], "left")
             .select(*GROUP, F.lit("pair").alias("part"), "item",
                     (F.coalesce("excess", F.lit(0)) + F.col("kept") * F.abs(F.col("base") - F.col("floor"))).cast("long").alias("value")))
    out_pair = pairs.withColumn("rank", F.row_number().over(best.orderBy(F.desc("value"), "item")))
    return out_pair.unionByName(out_term).join(name, GROUP).select("lang", "source", "part", "item", "value", "rank")
