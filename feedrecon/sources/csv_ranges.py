r"""Large CSV files read by many tasks, quoted line breaks included.

A line end inside quotes is no record end, so a task that starts in the middle of a file must
know whether it starts inside quotes: that is the parity of the quotes before it. Files over one
split are dealt with in three ways (smaller ones are one task anyhow):

* ``plain``: every line has an even number of quotes, so no record goes over a line end. One JVM
  pass over the lines tells; the ordinary reader then splits the file.
* ``ranges``: some record does. Each range counts its quotes and, for both parities it may start
  with, gathers the unfinished record at either end; a prefix sum over the ranges of a file
  (one row per range) gives every range its parity. The ranges then emit their whole
  records, records over a border are put together from their pieces, and ``from_csv`` parses
  them on the JVM side.
* ``whole``: quotes in places where they don't follow RFC 4180 (a quote inside an unquoted cell),
  blank-only lines or lone carriage returns, for which parity says nothing: one task, as before.

All three give the rows of the multi-line reader. Files are read through Spark's text source, so any
store that Spark reads will do. A range is a split of that source, known by its file and first byte;
if the splits of the second pass are not those of the first, the job fails instead of guessing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLAIN, RANGES, WHOLE = "plain", "ranges", "whole"
PROBE = ("path string, block long, quotes long, bad0 boolean, bad1 boolean, records0 long, head string, closed boolean, "
         "tail0 string, tail1 string")


def file_path():
    """The row's file, spelled as the listing spells it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.replace(decoded, F.lit("file:///"), F.lit("file:/"))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "\n").option("pathGlobFilter", "*").text([escaped(p) for p in paths])
            .select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"))


def escaped(path: str) -> str:
    """A path as a glob pattern that matches only itself."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def split_bytes(spark: SparkSession) -> int:
    """Files up to this length are one split of Spark's readers."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def ways(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """How each of the (large) files is read."""
    if not paths:
        return {}
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    body = F.regexp_replace("value", "\r$", "")
    blank = (F.trim(body) == "") & (body != "")
    lone = F.contains(body, F.lit("\r"))
    seen = {r.path: r for r in _lines(spark, paths).groupBy("path").agg(
        F.count_if(quotes % 2 == 1).alias("odd"), F.count_if(blank | lone).alias("odd_lines")).collect()}     # one row per large file
    out = {p: PLAIN if p not in seen or (seen[p].odd == 0 and seen[p].odd_lines == 0) else WHOLE if seen[p].odd_lines else RANGES for p in paths}
    doubtful = [p for p, w in out.items() if w == RANGES]
    if doubtful:
        irregular = {r.path for r in _borders(probe(spark, doubtful)).where(F.when(F.col("inside"), F.col("bad1")).otherwise(F.col("bad0")))
                     .select("path").distinct().collect()}
        out.update({p: WHOLE for p in irregular})
    return out


def _probe_lines() -> callable:
    """The task's function, with all it needs inside."""
    def passed(line: str, inside: bool) -> tuple[bool, bool]:
        """(a quote stands where it may not, inside quotes after the line)"""
        bad, at, end = False, line.find('"'), len(line) - line.endswith("\r")
        while at >= 0:
            if inside:
                bad |= at + 1 < end and line[at + 1] not in ',"'
            else:
                bad |= at > 0 and line[at - 1] not in ',"'
            inside = not inside
            at = line.find('"', at + 1)
        return bad, inside

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("path", "block", "value")], strict=True)

    def probed(batches):
        import pyarrow as pa

        def out(key, s):
            return pa.RecordBatch.from_pydict({
                "path": [key[0]], "block": pa.array([key[1]], pa.int64()), "quotes": pa.array([s["quotes"]], pa.int64()),
                "bad0": [s["bad"][0]], "bad1": [s["bad"][1]], "records0": pa.array([s["records"]], pa.int64()),
                "head": pa.array(["\n".join(s["head"])], pa.string()), "closed": [s["closed"]],
                "tail0": pa.array(["\n".join(s["open"][0])], pa.string()), "tail1": pa.array(["\n".join(s["open"][1])], pa.string())})

        key, s = None, None
        for path, block, line in rows(batches):
            if (path, block) != key:
                if key is not None:
                    yield out(key, s)
                key = (path, block)
                s = {"quotes": 0, "bad": [False, False], "records": 0, "inside": [False, True], "head": [], "closed": False, "open": [[], []]}
            s["quotes"] += line.count('"')
            for start in (0, 1):
                bad, inside = passed(line, s["inside"][start])
                s["bad"][start] |= bad
                if start and not s["closed"]:                 # still in the record that the range starts inside of
                    s["head"].append(line)
                    s["closed"] = not inside
                elif inside:
                    s["open"][start].append(line)
                else:
                    s["open"][start] = []
                    s["records"] += not start
                s["inside"][start] = inside
        if key is not None:
            yield out(key, s)
    return probed


def probe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per range: its quotes, whether a quote stands where it may not (starting outside and inside quotes),
    the rest of the record it starts inside of, and the unfinished record at its end, for both cases."""
    return _lines(spark, paths).mapInArrow(_probe_lines(), PROBE)


def _borders(probed: DataFrame) -> DataFrame:
    """``inside``: whether a range starts inside quotes, by a prefix sum over a file's ranges."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return probed.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def _records() -> callable:
    def read(batches):
        import pyarrow as pa
        key, inside, header, held, out = None, False, False, [], []
        for batch in batches:
            for path, block, start, line in zip(*[batch.column(c).to_pylist() for c in ("path", "block", "inside", "value")], strict=True):
                if (path, block) != key:
                    if start is None:
                        raise RuntimeError(f"{path} was split differently at byte {block} than when its quotes were counted")
                    key, inside, skip, held, header = (path, block), start, start, [], block == 0
                inside ^= line.count('"') % 2 == 1
                if skip:                                        # the end of a record of the range before
                    skip = inside
                    continue
                held.append(line)
                if not inside:
                    text = "\n".join(held)
                    held = []
                    if header:
                        header = False
                    else:
                        out.append((path, text))
            yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in out], pa.string()), "record": pa.array([r for _, r in out], pa.string())})
            out = []
    return read


def read_ranges(spark: SparkSession, paths: list[str], schema: str, options: dict[str, str]) -> DataFrame:
    """``path`` and the columns of ``schema`` for every record of the files (headers left out)."""
    ranges = _borders(probe(spark, paths))
    start = ranges.select("path", "block", "inside")                # one row per split
    inner = (_lines(spark, paths).join(F.broadcast(start), ["path", "block"], "left").select("path", "block", "inside", "value")
             .mapInArrow(_records(), "path string, record string"))
    # records over a border: a piece that opens, pieces in between, a piece that closes
    pieces = ranges.select("path", "block", "records0", F.explode(F.array(
        F.struct(F.lit(0).alias("at"), F.col("inside").alias("there"), F.col("head").alias("text"), F.lit(0).alias("opens")),
        F.struct(F.lit(1).alias("at"), F.when(F.col("inside"), F.col("closed") & (F.col("tail1") != "")).otherwise(F.col("tail0") != "").alias("there"),
                 F.when(F.col("inside"), F.col("tail1")).otherwise(F.col("tail0")).alias("text"), F.lit(1).alias("opens")))).alias("p")
        ).where("p.there").select("path", "block", "records0", "p.*")
    nth = Window.partitionBy("path").orderBy("block", "at")
    across = (pieces.withColumn("nth", F.sum("opens").over(nth)).groupBy("path", "nth")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "text"))), lambda x: x["text"]), "\n").alias("record"),
                   F.min(F.struct("block", "records0")).alias("from")))
    # the first record of a file is its header
    across = across.where(~((F.col("from.block") == 0) & (F.col("from.records0") == 0))).select("path", "record")
    record = F.regexp_replace("record", "\r$", "")
    rows = inner.unionByName(across).select("path", record.alias("record")).where("record <> ''")
    return rows.select("path", F.from_csv("record", schema, options).alias("row")).select("path", "row.*")
