r"""Line dedup by a distributed suffix array (native).

Every document is a sequence of line ids. A run of lines that occurs earlier in
the corpus (order: doc_id, nulls first, then line number) and holds at least
``min_words`` words is a later copy and is deleted; the first copy stays. So is a whole
document of fewer words that equals an earlier one.

* **Line ids.** Lines that occur once break every repeated run, so only lines
  that occur at least twice are kept, as stretches of consecutive repeated
  lines; stretches with too few words in all are dropped at once.
* **Suffix array by prefix doubling.** Rank ``k`` of a position orders the
  suffixes by their first ``2^k`` lines. Rank ``k + 1`` is the place of the pair
  (rank ``k`` here, rank ``k`` at ``2^k`` lines on) among the distinct pairs, which
  are counted, range-partitioned and sorted. Pairs that occur once are
  discarded, so the table shrinks from level to level. As each line counts at
  least one word, ``log2(min_words)`` levels suffice.
* **Longest-common-prefix intervals.** The suffixes that share their first ``n``
  lines (``2^k <= n < 2^(k+1)``) are one interval of the suffix array: those with
  equal ranks ``k`` at the run's first line and at ``2^k`` lines before its end. So
  an interval is a group of equal rank pairs and its first member a ``min``; no
  scan along the whole array is needed.
* **Maximal runs.** A repeated run of at least ``min_words`` words is the union of
  the shortest runs of that size that start at its lines and those that end at
  its lines (the latter cover its end). So the shortest run forwards from each
  line and backwards from each line are looked up; every member of an interval but the
  first is a later copy, and the overlapping copies joined are the maximal runs.

Nothing gathers a group: a line or pair that holds a third of all rows is
counted map-side, and its join is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.util import WORD, boxed, field, remove, stored, unboxed

#: A repeated run is deleted from this many words on.
MIN_WORDS = 50
DOC = ["d", "th"]


def line_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``d, th, of, i, h1, h2, w``: document (id and text hash), its lines (0 for an empty text), line number,
    line id (two 64-bit hashes) and words (at least 1), one row per line. Null texts have no line."""
    body = F.col(f"`{text}`")
    # what holds for a document is computed before its lines are dealt out, once
    whole = df.select(F.col(f"`{key}`").alias("d"), F.xxhash64(body).alias("th"), F.split(body, "\n").alias("lines"), body.alias("body"))
    whole = whole.select("d", "th", F.when(F.col("body") == "", 0).otherwise(F.size("lines")).alias("of"), "lines")
    lines = whole.select("d", "th", "of", F.posexplode("lines").alias("i", "line"))
    return lines.select("d", "th", "of", "i", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                        F.greatest(F.regexp_count("line", F.lit(WORD)), F.lit(1)).alias("w"))


def _names(groups: DataFrame, a: str, b: str, tag: str) -> DataFrame:
    """Order-preserving ids for the distinct pairs that occur at least twice."""
    return stored(groups.where("n > 1").select(a, b).repartitionByRange(a, b).sortWithinPartitions(a, b)
                  .withColumn("id", F.monotonically_increasing_id()), tag)


def repeated_stretches(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, th, seg, i, w, upto, total, r``: lines that occur at least twice, in
    stretches (``seg``) of at least ``min_words`` words or of a whole document; ``upto`` counts the
    stretch's words up to the line, ``r`` is rank 0."""
    names = _names(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "h1", "h2", "line-names")
    rows = lines.join(names, ["h1", "h2"]).select("d", "th", "of", "i", "w", F.col("id").alias("r"))
    by_line = Window.partitionBy(*DOC).orderBy("i")
    once = rows.withColumn("before", F.lag("i").over(by_line)).where("before IS NULL OR before <> i")  # a repeated row
    seg = once.withColumn("seg", F.col("i") - F.row_number().over(by_line))
    part = Window.partitionBy(*DOC, "seg")
    return (seg.withColumn("total", F.sum("w").over(part)).withColumn("lines", F.count(F.lit(1)).over(part))
            .where((F.col("total") >= min_words) | (F.col("lines") == F.col("of")))
            .withColumn("upto", F.sum("w").over(part.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
            .select(*DOC, "seg", "i", "w", "upto", "total", "r"))


def shortest_runs(stretches: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, th, start, n``: for each line the shortest run from it, and the
    shortest run up to it, with at least ``min_words`` words in its stretch; of a document
    with fewer words, all of it."""
    part = Window.partitionBy(*DOC, "seg")
    back = F.max("i").over(part.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words))
    s = (stretches.withColumn("ahead", F.col("upto") - F.col("w"))
         .withColumn("first", F.min("i").over(part)).withColumn("last", F.max("i").over(part))
         .withColumn("start_back", F.coalesce(back + 1, F.when(F.col("upto") >= min_words, F.col("first")))))
    # descending, the rows before are those with at least min_words more words ahead of them
    beyond = F.min("i").over(part.orderBy(F.col("ahead").desc()).rangeBetween(Window.unboundedPreceding, -min_words))
    s = s.withColumn("end", F.coalesce(beyond - 1, F.when(F.col("total") - F.col("ahead") >= min_words, F.col("last"))))
    runs = F.array(F.struct(F.col("i").alias("start"), (F.col("end") - F.col("i") + 1).alias("n")),
                   F.struct(F.col("start_back").alias("start"), (F.col("i") - F.col("start_back") + 1).alias("n")),
                   F.struct(F.col("first").alias("start"),
                            F.when((F.col("total") < min_words) & (F.col("i") == F.col("first")), F.col("last") - F.col("first") + 1).alias("n")))
    return (s.select(*DOC, F.explode(F.array_distinct(runs)).alias("run")).select(*DOC, "run.*")
            .where("start IS NOT NULL AND n IS NOT NULL"))


def next_ranks(ranks: DataFrame, k: int) -> DataFrame:
    """Rank ``k + 1`` from rank ``k`` (``d, th, i, r``)."""
    on = Window.partitionBy(*DOC).orderBy("i").rangeBetween(2 ** k, 2 ** k)
    pairs = ranks.withColumn("r2", F.max("r").over(on)).where("r2 IS NOT NULL")
    names = _names(pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("n")), "r", "r2", f"run-names-{k + 1}")
    out = stored(pairs.join(names, ["r", "r2"]).select(*DOC, "i", F.col("id").alias("r")), f"ranks-{k + 1}")
    remove(names)
    return out


def later_copies(runs: DataFrame, ranks: DataFrame, k: int) -> DataFrame:
    """``d, th, start, n`` of the runs of ``2^k`` to ``2^(k+1) - 1`` lines that are
    members, but not the first member, of their longest-common-prefix interval."""
    mine = runs.where((F.col("n") >= 2 ** k) & (F.col("n") < 2 ** (k + 1)))
    head = ranks.select(F.col("d").alias("d1"), F.col("th").alias("t1"), F.col("i").alias("i1"), F.col("r").alias("head"))
    tail = ranks.select(F.col("d").alias("d2"), F.col("th").alias("t2"), F.col("i").alias("i2"), F.col("r").alias("tail"))
    named = (mine.join(head, F.col("d").eqNullSafe(F.col("d1")) & (F.col("th") == F.col("t1")) & (F.col("start") == F.col("i1")))
             .join(tail, F.col("d").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2"))
                   & (F.col("start") + F.col("n") - 2 ** k == F.col("i2")))
             .select(*DOC, "start", "n", "head", "tail", F.struct("d", "th", "start").alias("place")))
    named = stored(named, f"intervals-{k}")
    # stored, so that the join below deals both sides anew and a hot interval can be split
    first = stored(named.groupBy("n", "head", "tail").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("members"))
                   .where("members > 1").drop("members"), f"first-copies-{k}")
    return named.join(first, ["n", "head", "tail"]).where("place > first").select(*DOC, "start", "n")


def joined_spans(copies: DataFrame) -> DataFrame:
    """``d, th, spans``: the overlapping or touching later copies of a document as maximal (first, last) lines."""
    c = copies.select(*DOC, "start", (F.col("start") + F.col("n") - 1).alias("end"))
    by = Window.partitionBy(*DOC).orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    c = c.withColumn("opens", F.coalesce((F.col("start") > reach + 1).cast("int"), F.lit(1)))
    c = c.withColumn("span", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spans = c.groupBy(*DOC, "span").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    return spans.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``d, th, spans`` of the documents that hold a later copy."""
    lines = stored(line_table(df, key, text), "lines")
    stretches = stored(repeated_stretches(lines, min_words), "stretches")
    remove(lines)
    runs = stored(shortest_runs(stretches, min_words), "runs")
    longest = runs.agg(F.max("n")).first()[0] or 0
    ranks, k, found = stretches.select(*DOC, "i", "r"), 0, None
    while 2 ** k <= longest:
        copies = later_copies(runs, ranks, k)
        found = copies if found is None else found.unionByName(copies)
        k += 1
        if 2 ** k <= longest:
            ranks = next_ranks(ranks, k - 1)
    if found is None:
        found = runs
    return stored(joined_spans(found), "spans")


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``df`` with its columns, later copies cut out of the text,
    and ``removed_lines`` (int) and ``removed_spans`` (text: ``first-last,…``, lines from 0).

    Null texts stay null and empty ones empty; a document of nothing but later
    copies keeps an empty text; rows repeated with equal id and text are one
    document, so they don't make each other copies and all get the same result;
    rows of equal id and different text are ordered by the text's hash; an
    empty table stays empty. Lines end at ``\\n``; blank lines count as one word."""
    spans = repeated_spans(df, key, text, min_words)
    body = field(df, text)
    rows = boxed(df).join(spans.hint("shuffle_hash"),
                          field(df, key).eqNullSafe(F.col("d")) & (F.xxhash64(body) == F.col("th")), "left")
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda x, i: ~F.exists(
        "spans", lambda s: (i >= s["first"]) & (i <= s["last"]))), "\n")
    removed = F.aggregate("spans", F.lit(0), lambda n, s: (n + s["last"] - s["first"] + 1).cast("int"))
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["last"])), ",")
    return unboxed(rows, df.columns, **{
        text: F.when(F.col("spans").isNull(), body).otherwise(kept),
        "removed_lines": F.coalesce(removed, F.lit(0)), "removed_spans": F.coalesce(shown, F.lit(""))})
