"""Legacy CSV feeds on storage: list, read headers, classify, read as text.

* The listing is a table (path, length, time of change) made by Spark's own file index through the
  session's Hadoop file system. A missing folder or a store that denies access raises; files whose
  name Spark's readers would skip (``_x.csv``, ``.x.csv``) are reported as unknown feeds instead of
  vanishing; what lies in a folder that is itself called ``x.csv`` is no feed.
* A feed is known by the shortest end of its path that is unique in the
  folder: its file name, or more parts where two folders hold equal names.
* A header is the first CSV record of a file; all headers are read in one job
  (each task reads as many bytes of its files as the record needs). The
  task's code is self-contained: executors need no copy of this package.
* Files are read with an all-string positional schema, cells kept as text (``""`` escapes
  honoured), then bound onto the canonical slots. Quoted cells may hold line breaks; files
  over one split are read by many tasks all the same (``csv_ranges``). Records are counted by
  the same readers that load them.

Up to ``FEW`` files the per-file tables are small enough to be kept on the driver and each group
of equal headers is a scan of its own. Beyond that they stay distributed: the driver gets the distinct
(layout, header) pairs only, and one scan of the folder is joined with the file table by file path.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedrecon.layouts import LAYOUTS, SLOTS, Layout
from feedrecon.operators.classify import UNKNOWN, classify_headers, unknown_message
from feedrecon.operators.normalise import bind_layout
from feedrecon.session import file_system, glob_status, local_table, new_work_dir
from feedrecon.sources import csv_ranges as CR

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "encoding": "UTF-8"}
HEADER_CHUNK = 64 * 1024
SLOT_SCHEMA = "feed string, ver string, " + ", ".join(f"{c} string" for c in SLOTS)
LISTED = "path string, length long, modified long, hidden boolean, feed string"
CLASSIFIED = ("feed string, path string, header array<string>, version string, matches long, detection string, "
              "length long, modified long")
#: Files up to which per-file tables are local and groups of equal headers are scanned apart.
FEW = 10_000
#: Entries of a folder up to which the driver asks for each one's length and time itself.
LOCAL_LISTING = 512


def is_hidden(path: str) -> bool:
    """Names Spark's file readers skip."""
    return path.rsplit("/", 1)[-1].startswith(("_", "."))


def held(df: DataFrame, tag: str, order: str | None = None) -> DataFrame:
    """A per-file table evaluated once, in the order of a column if asked for: a local one up to ``FEW`` rows, else stored."""
    spark = df.sparkSession
    rows = df.limit(FEW + 1).collect()
    if len(rows) <= FEW:
        return local_table(spark, sorted(rows, key=lambda r: r[order]) if order else rows, df.schema)
    path = new_work_dir(spark, tag)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.orderBy(order) if order else stored


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """SRC-1: ``path, length, modified, hidden, feed`` of every ``*.csv`` directly in ``directory`` (a folder or a glob of
    folders). Hidden names are listed too. An empty folder has no
    feeds; a folder that is not there, or cannot be listed, raises."""
    directory = directory.rstrip("/")
    if not glob_status(spark, directory):
        raise FileNotFoundError(f"no such feed folder: {directory}")
    pattern = f"{directory}/*.csv"
    fs, path = file_system(spark, pattern)
    found = fs.globStatus(path) or []
    if len(found) <= LOCAL_LISTING:
        rows, depth = _statuses(list(found)), 1
        while len({tuple(r[0].split("/")[-depth:]) for r in rows}) < len(rows):
            depth += 1
        return local_table(spark, [(*r, "/".join(r[0].split("/")[-depth:])) for r in rows], LISTED)
    hidden = spark.createDataFrame(_statuses(glob_status(spark, f"{directory}/[._]*.csv")), "path string, length long, modified long, hidden boolean")
    rows = hidden.where("hidden").unionByName(
        _indexed(spark, pattern, len(path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().split("/"))))
    rows = rows.withColumn("path", _same_scheme(F.col("path")))
    return held(named(rows).select(*[c.split()[0] for c in LISTED.split(", ")]), "listing")


def _statuses(found: list) -> list[tuple]:
    """What the file system says of some files (folders left out): path, length, time of change, hidden."""
    rows = [(s.getPath().toString(), s.getLen(), 1000 * s.getModificationTime()) for s in found if s.isFile()]
    return [("file:/" + p[len("file:"):].lstrip("/") if p.startswith("file:") else p, n, t, is_hidden(p)) for p, n, t in rows]


def _indexed(spark: SparkSession, pattern: str, depth: int) -> DataFrame:
    """The same from Spark's file index, which lists in parallel and without reading content. It shows neither hidden
    names nor, in a scan, empty files; and it enters folders that match, whose files lie deeper than ``depth``."""
    index = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    shown = index.select("path", "length", F.unix_micros("modificationTime").alias("modified"), F.lit(False).alias("hidden"))
    if len(index._jdf.inputFiles()) > shown.count():
        every = spark.createDataFrame([(unquote(p),) for p in index.inputFiles()], "path string")
        empty = every.withColumn("path", _same_scheme(F.col("path"))).join(
            shown.select(_same_scheme(F.col("path")).alias("path")), "path", "left_anti")
        shown = shown.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("modified"),
                                               F.lit(False).alias("hidden")))
    return shown.where(F.size(F.split(_same_scheme(F.col("path")), "/")) == depth)


def named(files: DataFrame) -> DataFrame:
    """``feed``: as many trailing parts of the path as tell the files apart (one: the file name)."""
    depth = 1
    while True:
        names = files.withColumn("feed", feed_name(F.col("path"), depth))
        n = names.agg(F.count(F.lit(1)).alias("files"), F.count_distinct("feed").alias("names")).first()
        if n.names == n.files:
            return names
        depth += 1


def list_feeds(spark: SparkSession, directory: str) -> list[str]:
    """The paths of ``list_files``, by file name, then path."""
    return sorted((r.path for r in list_files(spark, directory).collect()), key=lambda p: (p.rsplit("/", 1)[-1], p))


def _same_scheme(path: Column) -> Column:
    """One spelling of a local path."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def feed_name(path: Column, depth: int) -> Column:
    """A feed's name from its path."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, -depth, depth), "/")


def _header_reader(chunk_size: int):
    """The function that reads headers in tasks, with everything it needs inside."""
    def first_record(path: str) -> list[str]:
        import csv
        import io

        from pyarrow import fs
        if path.startswith("s3a://"):
            path = "s3://" + path[len("s3a://"):]
        if path.startswith("file:"):
            system, name = fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
        elif "://" in path:
            system, name = fs.FileSystem.from_uri(path)
        else:
            system, name = fs.LocalFileSystem(), path
        data, ended = b"", False
        with system.open_input_stream(name) as f:
            while True:
                chunk = f.read(chunk_size)       # a short read is not the end of a file; an empty one is
                data, ended = data + chunk, not chunk
                rows = csv.reader(io.StringIO(data.decode("utf-8-sig", errors="replace"), newline=""))
                row = next(rows, [])
                if ended or next(rows, None) is not None:      # complete once a second record has started
                    return row

    def read(batches):
        for pdf in batches:
            header = [None if h else first_record(p) for p, h in zip(pdf["path"], pdf["hidden"], strict=True)]
            yield pdf[["feed", "path", "length", "modified"]].assign(header=header)[["feed", "path", "header", "length", "modified"]]

    return first_record, read


def first_record(path: str) -> list[str]:
    """The first CSV record of a file (quotes and doubled quotes honoured, a byte-order mark dropped)."""
    return _header_reader(HEADER_CHUNK)[0](path)


def read_headers(listing: DataFrame) -> DataFrame:
    """SRC-2: ``feed, path, header`` (array of names, in file order), ``length, modified`` of every
    listed file, in one job. An empty file has an empty header, a hidden one none (both UNKNOWN)."""
    n = listing.sparkSession.sparkContext.defaultParallelism
    return listing.repartition(n).mapInPandas(_header_reader(HEADER_CHUNK)[1], "feed string, path string, header array<string>, length long, modified long")


def classify_files(listing: DataFrame, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """``feed, path, header, version, matches, detection, length, modified`` of listed files; ``detection`` is the
    layout or ``UNKNOWN: <message>``. The headers are read once."""
    c = classify_headers(read_headers(listing), layouts=layouts)
    sorted_cols = F.array_join(F.array_sort("header"), ",")
    text = F.when(F.col("header").isNull(), F.lit("UNKNOWN: hidden file name, rename it to load it")) \
        .when(F.col("version") == UNKNOWN, F.concat(F.lit("UNKNOWN: "), unknown_message(sorted_cols, layouts))) \
        .otherwise(F.col("version"))
    return held(c.withColumn("detection", text).select(*[x.split()[0] for x in CLASSIFIED.split(", ")]), "classified", "feed")


def classify_directory(spark: SparkSession, directory: str, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """CLS-4: every CSV of the folder, name-sorted, with its layout (``classify_files``)."""
    return classify_files(list_files(spark, directory), layouts)


def _positional_schema(width: int) -> StructType:
    """All-string schema with one field per header position (``c0`` …), so
    duplicate or case-colliding header names never clash."""
    return StructType([StructField(f"c{i}", StringType(), True) for i in range(width)])


def _reader(spark: SparkSession, multi_line: bool, width: int):
    return spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower()).schema(_positional_schema(max(width, 1)))


def csv_rows(spark: SparkSession, paths: list[str], width: int, multi_line: bool = True, ways: dict[str, str] | None = None) -> DataFrame:
    """SRC-3: ``path, c0 … c<width-1>``: the records of the files, header and blank lines left out. Files with a
    way of their own (``csv_ranges.ways``) are read by it; ``multi_line=False`` is for feeds whose cells never hold a line break."""
    ways = ways or {}
    by: dict[str, list[str]] = {}
    for p in paths:
        by.setdefault(ways.get(p, CR.WHOLE if multi_line else CR.PLAIN), []).append(p)
    out = None
    for way, some in sorted(by.items()):
        if way == CR.RANGES:
            df = CR.read_ranges(spark, some, _positional_schema(max(width, 1)).simpleString()[len("struct<"):-1].replace(":", " "), CSV_OPTIONS)
        else:
            df = _reader(spark, way == CR.WHOLE, width).csv([CR.escaped(p) for p in some]).select(CR.file_path().alias("path"), "*")
        out = df if out is None else out.unionByName(df)
    return out


def large_file_ways(spark: SparkSession, files: DataFrame, multi_line: bool = True) -> dict[str, str]:
    """How the files over one split are to be read (none of them where line breaks are ruled out)."""
    if not multi_line:
        return {}
    large = files.where(F.col("length") > CR.split_bytes(spark)).select("path").collect()
    return CR.ways(spark, [r.path for r in large])


def _positions(header: list[str]) -> dict[str, int]:
    """A repeated name binds its last occurrence (a row read as a dict)."""
    return {n: i for i, n in enumerate(header)}


def read_layout_files(spark: SparkSession, paths: list[str], header: list[str], version: str, names: DataFrame, multi_line: bool = True,
                      layouts: dict[str, Layout] = LAYOUTS, ways: dict[str, str] | None = None) -> DataFrame:
    """SRC-3: files of one layout sharing one header → slot form with ``feed`` (from ``names``: ``path, feed``).
    The last occurrence of a duplicated name wins, as when a record is read
    into a dict keyed by the header."""
    df = csv_rows(spark, paths, len(header), multi_line, ways).join(F.broadcast(names), "path")
    bound = df.select("feed", *[F.col(f"c{i}").alias(n) for n, i in _positions(header).items() if n != "feed"],
                      *[F.col(f"c{i}").alias("feed ") for n, i in _positions(header).items() if n == "feed"])
    return bind_layout(bound, layouts[version], "feed")


def read_joined(spark: SparkSession, directory: str, classified: DataFrame, multi_line: bool = True,
                layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """The recognised feeds of a folder of many files in slot form: one scan of the folder, joined with the file
    table by path. The driver gets one row per distinct (layout, header); every slot is one expression over the position
    it has in each. The file table is broadcast where Spark finds it small enough."""
    known = classified.where(F.col("version") != UNKNOWN)
    groups = [(r.version, list(r.header)) for r in known.select("version", "header").distinct().orderBy("version", "header").collect()]
    if not groups:
        return local_table(spark, [], SLOT_SCHEMA)
    pairs = local_table(spark, [(i, v, h) for i, (v, h) in enumerate(groups)], "grp int, version string, header array<string>")
    files = known.join(F.broadcast(pairs), ["version", "header"]).select("path", "feed", "grp", F.col("version").alias("ver"))
    scan = _reader(spark, multi_line, max(len(h) for _, h in groups)).csv(f"{directory.rstrip('/')}/*.csv")
    rows = scan.select(CR.file_path().alias("path"), "*").join(files, "path")

    def slot(name: str) -> Column:
        by: dict[str, list[int]] = {}
        for i, (v, h) in enumerate(groups):
            source = layouts[v].source_for(name)
            cell = "CAST(NULL AS STRING)" if source is None else f"coalesce(c{_positions(h)[source]}, '')" if source in h else "''"
            by.setdefault(cell, []).append(i)
        return F.expr("CASE " + " ".join(f"WHEN grp IN ({', '.join(map(str, g))}) THEN {cell}" for cell, g in by.items()) + " END").alias(name)

    return rows.select("feed", "ver", *[slot(c) for c in SLOTS])


def read_classified(spark: SparkSession, classified: DataFrame, multi_line: bool = True,
                    layouts: dict[str, Layout] = LAYOUTS, directory: str | None = None) -> DataFrame:
    """The recognised feeds among classified files in slot form (``feed, ver, raw_*``). Over ``FEW`` files of
    a folder are read by one joined scan."""
    known = classified.where(F.col("version") != UNKNOWN).select("path", "feed", "header", "version", "length")
    rows = known.limit(FEW + 1).collect()
    if len(rows) > FEW and directory is not None:
        return read_joined(spark, directory, classified, multi_line, layouts)
    rows = rows if len(rows) <= FEW else known.collect()
    ways = large_file_ways(spark, known, multi_line)
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for r in rows:
        groups.setdefault((r.version, tuple(r.header)), []).append(r.path)
    out = local_table(spark, [], SLOT_SCHEMA)
    names = known.select("path", "feed")
    for k, ((v, h), ps) in enumerate(sorted(groups.items())):
        f = read_layout_files(spark, ps, list(h), v, names, multi_line, layouts, ways)
        out = f if k == 0 else out.unionByName(f)
    return out


def read_feeds(spark: SparkSession, directory: str, multi_line: bool = True,
               layouts: dict[str, Layout] = LAYOUTS) -> tuple[DataFrame | None, DataFrame]:
    """All recognised feeds of a folder in slot form (None if it has none), and
    the classification of every file (incl. UNKNOWN ones)."""
    classified = classify_directory(spark, directory, layouts)
    if classified.where(F.col("version") != UNKNOWN).isEmpty():
        return None, classified
    return read_classified(spark, classified, multi_line, layouts, directory), classified


def count_records(spark: SparkSession, directory: str, multi_line: bool = True, listing: DataFrame | None = None) -> DataFrame:
    """SRC-4: data records per feed (``feed, source_count``), header excluded,
    blank lines ignored (P10), by the readers that load them. Hidden files are not counted."""
    listing = list_files(spark, directory) if listing is None else listing
    shown = listing.where(~F.col("hidden"))
    paths = [r.path for r in shown.select("path").limit(FEW + 1).collect()]
    if not paths:
        return spark.createDataFrame([], "feed string, source_count long")
    if len(paths) > FEW:
        df = _reader(spark, multi_line, 1).csv(f"{directory.rstrip('/')}/*.csv").select(CR.file_path().alias("path"))
    else:
        df = csv_rows(spark, paths, 1, multi_line, large_file_ways(spark, shown, multi_line))
    return (df.groupBy("path").agg(F.count(F.lit(1)).alias("source_count")).join(shown.select("path", "feed"), "path")
            .select("feed", "source_count"))


def feed_counts(spark: SparkSession, directory: str, classified: DataFrame | None = None, multi_line: bool = True,
                layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """CHK-1/CHK-2 input for a folder: every file with its layout (NULL when
    unknown) and its record count (0 for an empty file) — one row per file."""
    c = classified if classified is not None else classify_directory(spark, directory, layouts)
    files = c.select("feed", F.when(F.col("version") != UNKNOWN, F.col("version")).alias("ver"))
    listing = c.select("path", "length", "modified", F.col("header").isNull().alias("hidden"), "feed")
    return (files.join(count_records(spark, directory, multi_line, listing), "feed", "left")
            .select("feed", "ver", F.coalesce("source_count", F.lit(0)).cast("long").alias("source_count")))
