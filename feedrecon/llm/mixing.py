"""Mixing sources to target weights by Pareto order sampling (native).

1. Sizes are summed per source. Weights turn the sum of all sizes into one
   target per source; a target stops at ``max_copies`` times its source's size
   and the excess is reshared by weight. The end state of the resharing is the
   water level of a sorted prefix sum, so no loop is needed.
2. Each document is expected ``e = target / source size`` times: ``floor(e)``
   whole copies are certain, and the fraction is the inclusion probability of
   one further copy. With a document weight the expectation differs by
   document (``e`` times its relative weight, at most ``max_copies``).
3. Further copies are drawn by Pareto order sampling: documents are ranked by
   ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` a stable random number of the
   document, and taken in rank order until the words still missing to the
   target are reached (a sample of fixed size, counted in words: the last
   document enters if that brings the total nearer).

The cut is found without sorting a source: words are summed per (source, bin
of the rank), a prefix sum over those counts finds the bin of the cut, and
only that bin's documents are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.sharding import uniform
from feedrecon.llm.util import boxed, field, stored, unboxed, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Bins of the rank. A hot source of n documents orders n / BINS of them in one task.
BINS = 4096


def targets(sizes: DataFrame, weight: Column | None = None, max_copies: int = MAX_COPIES,
            share: float = 1.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row
    per source): ``share`` of all sizes dealt by weight, capped, reshared.

    Without ``weight`` the sources weigh 1, 2, 3, 1, … by code point, null
    last. The windows run over one row per source."""
    if weight is None:
        place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place + 1).cast("int"))
    w = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_copies)
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = (w.withColumn("caps_before", F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0)))
         .withColumn("weights_left", F.sum("w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share))))
    # a source is full when the level it would get from what the fuller ones leave exceeds its cap
    level = (F.col("wanted") - F.col("caps_before")) / F.col("weights_left")
    w = w.withColumn("open_level", F.when(F.col("w") * level < F.col("cap"), level))
    # every open source sees the same level, up to rounding: that of the first of them
    w = w.withColumn("level", F.min(F.when(F.col("open_level").isNotNull(),
                                           F.struct(F.col("caps_before"), F.col("open_level")))).over(everything))
    target = F.when(F.col("open_level").isNull(), F.col("cap").cast("double")) \
        .otherwise(F.col("w") * F.col("level")["open_level"])
    return w.select("source", "source_size", target.alias("target"))


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds divided by inclusion odds."""
    return (u / (F.lit(1.0) - u)) / (p / (F.lit(1.0) - p))


def _bin(rank: Column) -> Column:
    """Monotone in the rank, even for a rank that is an odds ratio: its place in (0, 1); null for a null rank."""
    return F.when(rank.isNotNull(), F.least(F.floor(rank / (rank + F.lit(1.0)) * F.lit(BINS)), F.lit(BINS - 1))).cast("int")


def documents_to_mix(key: Column, text: Column, source: Column, doc_weight: Column | None, seed: str) -> list[Column]:
    """The narrow columns a mix decides by: ``doc_id, size, source, g`` (weight),
    ``crc`` and ``u``, the document's stable random number: a hash of seed, key, size and checksum."""
    g = F.lit(1.0) if doc_weight is None else F.greatest(F.coalesce(doc_weight.cast("double"), F.lit(1.0)), F.lit(0.0))
    size, crc = word_count(text), F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    u = uniform(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), size.cast("string"), crc.cast("string"))
    return [key.alias("doc_id"), size.alias("size"), source.alias("source"), g.alias("g"), crc.alias("crc"), u.alias("u")]


def _expected(max_copies: int) -> Column:
    return F.least(F.col("per_weight") * F.col("g"), F.lit(float(max_copies)))


def _ranked(rows: DataFrame, per_source: DataFrame, max_copies: int) -> DataFrame:
    """Rows with their source's decision columns, whole copies, rank and bin.
    ``per_source`` has one row per source; Spark broadcasts it only below its size limit."""
    e = _expected(max_copies)
    return (rows.join(per_source, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
            .withColumn("whole", F.coalesce(F.floor(e), F.lit(0)).cast("long")).withColumn("p", e - F.floor(e))
            .withColumn("rank", F.when(F.col("p") > 0, pareto_rank(F.col("u"), F.col("p"))))
            .withColumn("bin", _bin(F.col("rank"))))


def decide(rows: DataFrame, weight: Column | None = None, max_copies: int = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """One row per source: ``of_source, source_size, target, per_weight`` and
    the cut of its ranking (``cut_bin``, ``last``: the last place taken in
    that bin). ``rows`` (the columns of ``documents_to_mix``) is read four
    times: store it first."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum(F.col("size") * F.col("g")).alias("weighted"))
    goal = targets(sums.select("source", "source_size"), weight, max_copies, share)
    per_weight = F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(F.lit(0.0))
    goal = stored(goal.join(sums.select(F.col("source").alias("of_source"), "weighted"),
                            F.col("source").eqNullSafe(F.col("of_source")))
                  .select("of_source", "source_size", "target", per_weight.alias("per_weight")), "mix-targets")
    r = _ranked(rows, goal, max_copies)
    # words still missing after the certain copies, and the bin of the ranking where they are reached
    bins = r.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("target").alias("target"),
                                          F.sum(F.col("size") * F.col("whole")).alias("sure"))
    by_source = Window.partitionBy("source")
    upto = by_source.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    in_bin = F.when(F.col("bin").isNotNull(), F.col("words")).otherwise(F.lit(0))
    cut = (bins.withColumn("missing", F.greatest(F.col("target") - F.sum("sure").over(by_source), F.lit(0.0)))
           .withColumn("in_bin", in_bin).withColumn("reached", F.sum("in_bin").over(upto))
           .where(F.col("bin").isNotNull() & (F.col("reached") >= F.col("missing")))
           .groupBy(F.col("source").alias("cut_source"))
           .agg(F.min(F.struct("bin", (F.col("reached") - F.col("in_bin")).alias("before"), "missing")).alias("cut")))
    # only the documents of that bin are put in order; equal places are one
    place = F.struct("rank", F.col("doc_id").cast("string").alias("id"), "size", "crc")
    near = (r.select("source", "bin", place.alias("place"), "size")
            .join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("bin") == F.col("cut.bin")))
            .groupBy("cut_source", "place").agg(F.sum("size").alias("words"), F.min("cut").alias("cut")))
    run = F.sum("words").over(Window.partitionBy("cut_source").orderBy("place")
                              .rowsBetween(Window.unboundedPreceding, 0))
    # a document that straddles the cut enters if at least half of it is missing
    enters = F.col("cut.before") + F.col("run") - F.col("words") / 2 <= F.col("cut.missing")
    last = (near.withColumn("run", run).groupBy("cut_source")
            .agg(F.min("cut.bin").alias("cut_bin"), F.max(F.when(enters, F.col("place"))).alias("last")))
    return (goal.join(last, F.col("of_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source"))


def _copies(rows: DataFrame, decisions: DataFrame, max_copies: int) -> DataFrame:
    place = F.struct("rank", F.col("doc_id").cast("string").alias("id"), "size", "crc")
    drawn = F.col("bin").isNotNull() & (
        F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))
        | ((F.col("bin") == F.col("cut_bin")) & F.coalesce(place <= F.col("last"), F.lit(False))))
    return _ranked(rows, decisions, max_copies).withColumn("copies", F.col("whole") + drawn.cast("long"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        doc_weight: str | None = None, weight: Column | None = None, max_copies: int = MAX_COPIES,
        share: float = 1.0, seed: str = "mix") -> DataFrame:
    """One row per row of ``df``: ``doc_id, size, source, source_size, target,
    copies, taken`` (words taken, repeats counted). Only ids, sizes and
    checksums are stored and shuffled, never texts.

    Null and empty texts have size 0; null sources form one source; null
    document weights count as 1; rows equal in key, size and checksum are one
    document repeated and share one decision; an empty table gives an empty
    result; reruns agree."""
    of = [F.col(f"`{c}`") for c in (key, text, source)]
    rows = stored(df.select(*documents_to_mix(*of, doc_weight and F.col(f"`{doc_weight}`"), seed)), "mix-rows")
    decisions = stored(decide(rows, weight, max_copies, share), "mix-decisions")
    return _copies(rows, decisions, max_copies).select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    doc_weight: str | None = None, weight: Column | None = None, max_copies: int = MAX_COPIES,
                    share: float = 1.0, seed: str = "mix") -> DataFrame:
    """The documents of the mix: every row of ``df`` as often as it is taken,
    all its columns kept. Texts are read once more and never shuffled: the
    decision of a source is one row, and each document finds its copies alone."""
    names = dict(key=key, text=text, source=source, doc_weight=doc_weight)
    narrow = stored(df.select(*documents_to_mix(**{k: v and F.col(f"`{v}`") for k, v in names.items()}, seed=seed)), "mix-rows")
    decisions = stored(decide(narrow, weight, max_copies, share), "mix-decisions")
    rows = boxed(df).select("row", *documents_to_mix(**{k: v and field(df, v) for k, v in names.items()}, seed=seed))
    taken = _copies(rows, decisions, max_copies).where(F.col("copies") > 0)
    return unboxed(taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")), df.columns)
