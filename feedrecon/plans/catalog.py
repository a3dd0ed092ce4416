"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each query reads the data directory's tables (through the derived credential
feeds) and runs one of the jobs over all of it. Outputs drop ``staged_at`` (a
run parameter) and render ``sample_values`` as one comma-joined string so that
results can be compared value by value with the SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.functions.rules import ntz
from feedrecon.layouts import LAYOUTS, SLOTS
from feedrecon.operators import checks as C
from feedrecon.operators import normalise as N
from feedrecon.operators import report as RP
from feedrecon.plans import scenarios as S
from feedrecon.operators import classify as CL
from feedrecon.operators import control as CT
from feedrecon.operators import export as EX
from feedrecon.operators import extensions as XT
from feedrecon.operators import ingest as IG
from feedrecon.functions import rules as R
from feedrecon.plans.jobs import ingest_directory, reconcile_kept
from feedrecon.session import at_once, new_work_dir
from feedrecon.sources import csv_feeds as CSV
from feedrecon.sources.fixtures import header_manifest, layout_feed
from feedrecon.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def flat_results(results: DataFrame) -> DataFrame:
    """Results with samples as one string (value-comparable)."""
    return results.withColumn("sample_values", F.array_join("sample_values", ","))


# ============================================================================ J2
def _normalise_layout(version: str) -> Query:
    lay = LAYOUTS[version]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        as_delivered = layout_feed(S.feeds(spark, sf_dir), lay)   # the layout's own column names
        return N.normalise(N.bind_layout(as_delivered, lay)).select(*N.CANONICAL)
    run.__name__ = f"normalise_{version}"
    return run


for _v in LAYOUTS:
    REGISTRY[f"normalise_{_v}"] = _normalise_layout(_v)


@query("normalise_all")
def normalise_all(spark, sf_dir):
    return S.staged_rows(spark, sf_dir)


N_RAW = ("raw_full_name", "raw_first_name", "raw_last_name", "raw_issue_date", "raw_status", "raw_type",
         "raw_preferred")


def _tagged(spark, sf_dir) -> DataFrame:
    return N.tag(S.feeds(spark, sf_dir), "k", "copy_no", *N_RAW)


@query("normalise_names")
def normalise_names(spark, sf_dir):
    return _tagged(spark, sf_dir).select("k", "copy_no", "source_schema_version", "first_name", "last_name")


@query("normalise_preferred")
def normalise_preferred(spark, sf_dir):
    return _tagged(spark, sf_dir).select("k", "copy_no", "source_schema_version", "raw_preferred", "preferred_name")


@query("normalise_dates")
def normalise_dates(spark, sf_dir):
    return _tagged(spark, sf_dir).select("k", "copy_no", "source_schema_version", "raw_issue_date", "issue_date")


@query("normalise_ids")
def normalise_ids(spark, sf_dir):
    return _tagged(spark, sf_dir).select("k", "copy_no", "source_schema_version", "student_id", "source_student_id")


@query("normalise_status")
def normalise_status(spark, sf_dir):
    return (_tagged(spark, sf_dir).groupBy("source_schema_version", "raw_status", "status")
            .agg(F.count(F.lit(1)).alias("rows")))


@query("normalise_codes")
def normalise_codes(spark, sf_dir):
    return (_tagged(spark, sf_dir).groupBy("source_schema_version", "raw_type", "credential_type")
            .agg(F.count(F.lit(1)).alias("rows")))


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    q = N.quarantined(_tagged(spark, sf_dir))
    return q.select("k", "copy_no", "source_schema_version", "source_student_id", "reason",
                    F.array_join("reasons", ",").alias("reasons"))


@query("quarantine_by_reason")
def quarantine_by_reason(spark, sf_dir):
    return N.quarantine_by_reason(N.tag(S.feeds(spark, sf_dir)))


# ============================================================================ J4
@query("staged_counts")
def staged_counts(spark, sf_dir):
    return C.staged_counts(S.staging(spark, sf_dir))


@query("row_counts")
def row_counts(spark, sf_dir):
    return flat_results(C.reconcile_row_counts(C.source_counts(S.feeds(spark, sf_dir)), S.staging(spark, sf_dir)))


@query("row_counts_tolerance")
def row_counts_tolerance(spark, sf_dir):
    return flat_results(C.reconcile_row_counts(C.source_counts(S.feeds(spark, sf_dir)), S.staging(spark, sf_dir),
                                               tolerance_pct=1.0))


# ============================================================================ J5
@query("null_profile")
def null_profile(spark, sf_dir):
    return C.null_profile(S.staging(spark, sf_dir), N.CANONICAL)


@query("null_assertions")
def null_assertions(spark, sf_dir):
    return flat_results(C.null_assertions(S.staging(spark, sf_dir)))


@query("null_assertions_empty")
def null_assertions_empty(spark, sf_dir):
    # The stored staging table of a run whose every record was rejected (no issue date parses).
    target = S.rejected_target(spark, sf_dir)
    return flat_results(C.null_assertions(IG.read_staging(spark, target).select(*N.CANONICAL)))


# ============================================================================ J6
@query("id_format")
def id_format(spark, sf_dir):
    return flat_results(C.check_id_format(S.staging(spark, sf_dir)))


@query("type_histogram")
def type_histogram(spark, sf_dir):
    return C.value_histogram(S.staging(spark, sf_dir), "credential_type")


@query("status_histogram")
def status_histogram(spark, sf_dir):
    return C.value_histogram(S.staging(spark, sf_dir), "status")


@query("allowed_types")
def allowed_types(spark, sf_dir):
    return flat_results(C.check_allowed(S.staging(spark, sf_dir), "credential_type", C.ALLOWED_CREDENTIAL_TYPES, 2, "FAIL"))


@query("allowed_status")
def allowed_status(spark, sf_dir):
    return flat_results(C.check_allowed(S.staging(spark, sf_dir), "status", C.ALLOWED_STATUSES, 3, "WARNING"))


@query("sample_values")
def sample_values(spark, sf_dir):
    """The samples every check attaches, one row per sample with its position."""
    res = RP.build_results(C.source_counts(S.feeds(spark, sf_dir)), S.staging(spark, sf_dir))
    return res.select("check_name", F.posexplode("sample_values").alias("pos", "sample"))


# ============================================================================ J7
@query("exact_duplicates")
def exact_duplicates(spark, sf_dir):
    return C.exact_duplicates(S.staging(spark, sf_dir))


@query("duplicate_excess")
def duplicate_excess(spark, sf_dir):
    g = C.exact_duplicates(S.staging(spark, sf_dir))
    return g.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                 F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("excess_rows"))


# ============================================================================ J8/J9
@query("school_conflicts")
def school_conflicts(spark, sf_dir):
    return C.conflicting(S.staging(spark, sf_dir), "student_id", "school_id")


@query("multi_version_ids")
def multi_version_ids(spark, sf_dir):
    return C.conflicting(S.staging(spark, sf_dir), "student_id", "source_schema_version")


@query("cross_version_consistency")
def cross_version_consistency(spark, sf_dir):
    p = C.student_profile(S.staging(spark, sf_dir))
    return p.where("multi_version AND multi_type").select("student_id")


# ============================================================================ J10
def _results(spark, sf_dir) -> DataFrame:
    return RP.build_results(C.source_counts(S.feeds(spark, sf_dir)), S.staging(spark, sf_dir))


@query("recon_results")
def recon_results(spark, sf_dir):
    return flat_results(_results(spark, sf_dir))


@query("recon_overall")
def recon_overall(spark, sf_dir):
    return RP.overall(_results(spark, sf_dir))


@query("recon_gate")
def recon_gate(spark, sf_dir):
    return RP.gate(_results(spark, sf_dir))


# ============================================================================ J1
@query("feed_classify")
def feed_classify(spark, sf_dir):
    return CL.classify_headers(header_manifest(spark, sf_dir)).select("feed", "version")


@query("feed_classify_ambiguous")
def feed_classify_ambiguous(spark, sf_dir):
    c = CL.classify_headers(header_manifest(spark, sf_dir))
    return c.where(F.col("matches") > 1).select("feed", "matches", "version")


@query("feed_classify_long")
def feed_classify_long(spark, sf_dir):
    long_form = header_manifest(spark, sf_dir).select("feed", F.explode("header").alias("column"))
    return CL.classify_long(long_form)


@query("feed_unknown")
def feed_unknown(spark, sf_dir):
    return CL.unknown_feeds(CL.classify_headers(header_manifest(spark, sf_dir))).select("feed", "sorted_columns", "message")


@query("feed_manifest")
def feed_manifest(spark, sf_dir):
    """CLS-4 over real files: per folder, layout and number of matches the files and the smallest and largest name."""
    folder, name = F.substring_index("feed", "/", 1), F.substring_index("feed", "/", -1)
    return (CSV.classify_directory(spark, multiline_all_feeds(spark, sf_dir))
            .groupBy(folder.alias("folder"), "version", "matches").agg(F.count(F.lit(1)).alias("files"), F.min(name).alias("first"), F.max(name).alias("last")))


@query("feed_manifest_damaged")
def feed_manifest_damaged(spark, sf_dir):
    """CLS-4 with damaged copies: a folder per layout, and one whose headers lost the id column."""
    folder = F.element_at(F.split("path", "/"), -2)
    rows = CSV.classify_directory(spark, exported_feeds(spark, sf_dir)).groupBy(folder.alias("folder"), "version", "matches").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("folder", "version", "matches")


# ============================================================================ J3 over files
def write_feed_files(f: DataFrame, band, root: str) -> str:
    """Delivered records as CSV files ``<layout>_<band>.csv``, cells as they came; the folder."""
    steps = []
    for v, lay in LAYOUTS.items():
        rows = f.where(F.col("ver") == v).withColumn("part", F.concat(F.lit(f"{v}_"), band))
        cells = {lay.source_for(s): s for s in SLOTS if lay.source_for(s)}
        out = rows.select("part", *[F.coalesce(cells[c], F.lit("")).alias(c) for c in lay.columns])
        steps.append(partial(EX.write_csv_files, out.repartition("part"), "part", f"{root}/parts-{v}", f"{root}/feeds"))
    at_once(f.sparkSession, *steps)
    return f"{root}/feeds"


def banded_feeds(spark: SparkSession, sf_dir: str) -> str:
    """All delivered records as CSV files by layout and year of update (``v1_2015.csv`` …; ``v1_none.csv`` holds those
    without a usable update time, mixed with some that have one)."""
    key = S.prepared_key(spark, sf_dir, "banded")
    with S._LOCK:
        if key not in _EXPORTED:
            root = new_work_dir(spark, "csv-banded")
            f = S.feeds(spark, sf_dir)
            u = R.lenient_updated_at(F.col("raw_updated_at"))
            band = F.when(u.isNull() | (F.col("k") % S.LATE_MOD == S.LATE_REM), "none").otherwise(F.year(u).cast("string"))
            _EXPORTED[key] = write_feed_files(f, band, root)
    return _EXPORTED[key]


def folder_runs(spark: SparkSession, sf_dir: str) -> IG.Tables:
    """Two runs over the folder of ``banded_feeds``, unchanged between them: the second opens only files that may hold
    something newer than the first one's time."""
    key = S.prepared_key(spark, sf_dir, "folder-runs")
    with S._LOCK:
        if key not in _EXPORTED:
            target = IG.Tables(new_work_dir(spark, "folder-runs"))
            for run_id, ts in (("run1", S.RUN1_TS), ("run2", S.RUN2_TS)):
                ingest_directory(spark, banded_feeds(spark, sf_dir), target, ts, run_id)
            _EXPORTED[key] = target.root
    return IG.Tables(_EXPORTED[key])


@query("files_skipped")
def files_skipped(spark, sf_dir):
    """FLT-1 over files: what both runs did with every file."""
    return IG.read_files(spark, folder_runs(spark, sf_dir)).select(
        "run_id", "file", "opened", "total_rows", "extracted_rows", "skipped_rows", "no_update_time_rows", _fmt_ts("newest").alias("newest"))


@query("files_two_runs")
def files_two_runs(spark, sf_dir):
    """ING-1 over the folder: what both runs staged, with files left unopened."""
    return _staged(spark, folder_runs(spark, sf_dir))


@query("recon_results_kept")
def recon_results_kept(spark, sf_dir):
    """CHK-12 after two runs over files, from the kept partial aggregates and the run's file table."""
    return flat_results(reconcile_kept(spark, folder_runs(spark, sf_dir), compact=2))


# ============================================================================ J3
def _fmt_ts(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def _state(spark, target) -> DataFrame:
    st = CT.current_state(CT.read_log(spark, target.control))
    return st.select("schema_version", _fmt_ts("last_processed_at").alias("last_processed_at"), "last_run_row_count",
                     _fmt_ts("last_run_timestamp").alias("last_run_timestamp"), _fmt_ts("created_at").alias("created_at"))


@query("incremental_extract")
def incremental_extract(spark, sf_dir):
    marks = spark.createDataFrame(
        [(v, S.RUN1_TS if v in ("v1", "v2", "v3", "v4") else CT.EPOCH) for v in LAYOUTS], "ver string, watermark timestamp_ntz")
    return IG.incremental_extract(S.feeds(spark, sf_dir), marks).select("k", "copy_no", "ver", "raw_updated_at")


@query("watermark_state")
def watermark_state(spark, sf_dir):
    return _state(spark, S.two_runs(spark, sf_dir)).drop("created_at")


@query("watermark_upsert")
def watermark_upsert(spark, sf_dir):
    return _state(spark, S.two_runs(spark, sf_dir))


@query("watermark_reset")
def watermark_reset(spark, sf_dir):
    return _state(spark, S.two_runs(spark, sf_dir, reset_versions=("v3", "v5")))


@query("watermark_advance")
def watermark_advance(spark, sf_dir):
    t = S.two_runs(spark, sf_dir)
    summ = IG.read_summaries(spark, t).where("run_id = 'run2'")
    dec = summ.groupBy(F.col("schema_version")).agg(F.sum("mapped_rows").alias("mapped_rows"),
                                                   F.sum("mapping_errors").alias("mapping_errors"))
    adv = (F.col("mapping_errors") == 0) | (F.col("mapped_rows") > 0)
    return dec.select("schema_version", "mapped_rows", "mapping_errors", adv.alias("advanced"))


def _staged(spark, target) -> DataFrame:
    return IG.read_staging(spark, target).select("run_id", *N.CANONICAL)


@query("ingest_append")
def ingest_append(spark, sf_dir):
    return _staged(spark, S.two_runs(spark, sf_dir)).where("run_id = 'run1'")


@query("ingest_two_runs")
def ingest_two_runs(spark, sf_dir):
    return _staged(spark, S.two_runs(spark, sf_dir))


@query("full_reload")
def full_reload(spark, sf_dir):
    return _staged(spark, S.two_runs(spark, sf_dir, full_reload_third=True))


@query("run_summary")
def run_summary(spark, sf_dir):
    t = S.two_runs(spark, sf_dir)
    return IG.read_summaries(spark, t).where("run_id = 'run2'").select(*IG.SUMMARY)


@query("run_totals")
def run_totals(spark, sf_dir):
    t = S.two_runs(spark, sf_dir)
    return IG.run_totals(IG.read_summaries(spark, t).where("run_id = 'run2'"))


@query("quarantine_table")
def quarantine_table(spark, sf_dir):
    t = S.two_runs(spark, sf_dir)
    return IG.read_quarantine(spark, t).select("run_id", "source_schema_version", "source_student_id", "reason", *SLOTS)


# ============================================================================ J11
def _export(version: str) -> Query:
    lay = LAYOUTS[version]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return EX.export_layout(S.staging(spark, sf_dir), lay, ntz(S.LOAD_TS))
    run.__name__ = f"export_{version}"
    return run


for _v in LAYOUTS:
    REGISTRY[f"export_{_v}"] = _export(_v)


@query("export_roundtrip")
def export_roundtrip(spark, sf_dir):
    """Every staged row written out in every layout and mapped back: rows per
    layout and rows whose compared fields changed (preferred name only where
    the layout carries it)."""
    st = S.staging(spark, sf_dir)
    orig = [F.col(c).alias(f"o_{c}") for c in N.CANONICAL]
    parts = []
    for v, lay in LAYOUTS.items():
        out = EX.export_layout(st.select("*", *orig), lay, ntz(S.LOAD_TS), *[f"o_{c}" for c in N.CANONICAL])
        back = N.tag(N.bind_layout(out, lay, *[f"o_{c}" for c in N.CANONICAL]), *[f"o_{c}" for c in N.CANONICAL])
        fields = ["student_id", "first_name", "last_name", "school_id", "credential_type", "issue_date", "status"]
        if lay.has_preferred:
            fields.append("preferred_name")
        same = F.col("accepted")
        for c in fields:
            same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        parts.append(back.select(F.lit(v).alias("layout"), same.alias("same")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("layout").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("same")).alias("mismatches"))


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Staged rows exported to CSV files, read back through the CSV source
    (header classification, positional binding) and normalised again."""
    d = exported_feeds(spark, sf_dir)
    slots, _ = CSV.read_feeds(spark, d)
    return N.normalise(slots).select(*N.CANONICAL)


def exported_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Staged rows written as CSV feeds, one folder per layout, plus for each
    layout a damaged copy whose header lost the layout's id column. Returns a
    glob over all feed files (each part file is one feed)."""
    key = S.prepared_key(spark, sf_dir)
    with S._LOCK:
        if key not in _EXPORTED:
            root = new_work_dir(spark, "csv-feeds")
            st, steps = S.staging(spark, sf_dir), []
            for v, lay in LAYOUTS.items():
                out = EX.export_layout(st.where(F.col("source_schema_version") == v), lay, ntz(S.LOAD_TS))
                steps += [partial(EX.write_csv, out, f"{root}/{v}"),
                          partial(EX.write_csv, out.select(*[c for c in lay.columns if c != lay.fingerprint[0]]), f"{root}/{v}_damaged")]
            at_once(spark, *steps)
            _EXPORTED[key] = f"{root}/*"
    return _EXPORTED[key]


_EXPORTED: dict[tuple, str] = {}


def large_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Staged rows of all layouts as one CSV file a layout, in two folders with equal file names (``broken/v1.csv`` …
    ``plain/v8.csv``): in the first every third record holds a quoted line break, in the second none does. Returns a glob over both."""
    key = S.prepared_key(spark, sf_dir, "large")
    with S._LOCK:
        if key not in _EXPORTED:
            root = new_work_dir(spark, "csv-large")
            st, steps = S.staging(spark, sf_dir), []
            third = F.pmod(F.unix_date("issue_date"), F.lit(3)) == 0
            broken = st.withColumn("school_id", F.when(third, F.concat("school_id", F.lit(',"East"\nwing'))).otherwise(F.col("school_id")))
            for folder, rows in (("broken", broken), ("plain", st)):
                for v, lay in LAYOUTS.items():
                    out = EX.export_layout(rows.where(F.col("source_schema_version") == v).withColumn("part", F.lit(v)), lay, ntz(S.LOAD_TS), "part")
                    steps.append(partial(EX.write_csv_files, out.coalesce(1), "part", f"{root}/parts-{folder}-{v}", f"{root}/feeds/{folder}"))
            at_once(spark, *steps)          # one file is one task
            _EXPORTED[key] = f"{root}/feeds/*"
    return _EXPORTED[key]


@query("csv_multiline_roundtrip")
def csv_multiline_roundtrip(spark, sf_dir):
    """SRC-3 over one file a layout, with and without quoted line breaks: files over one split are read by ranges."""
    slots, _ = CSV.read_feeds(spark, large_feeds(spark, sf_dir))
    return N.normalise(slots, "feed").select(F.substring_index("feed", "/", 1).alias("folder"), *N.CANONICAL)


@query("folder_row_counts")
def folder_row_counts(spark, sf_dir):
    """SRC-4 over one file a layout, with quoted line breaks and equal file names."""
    return CSV.feed_counts(spark, large_feeds(spark, sf_dir))


#: Files a layout has in each folder of ``multiline_all_feeds``: four, and one more for so many of its rows.
FILE_ROWS = 16_384


def multiline_all_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Staged rows of every layout as CSV feeds with a quoted line break in the
    name and in the school id (a cell every layout has), in two folders with
    equal file names (``s1/v1_0.csv`` … ``s2/v8_3.csv``). The number of files
    grows with the rows. Returns a glob over both folders."""
    key = S.prepared_key(spark, sf_dir, "multiline-all", FILE_ROWS)
    with S._LOCK:
        if key not in _EXPORTED:
            root = new_work_dir(spark, "csv-multiline-all")
            staged = S.staging(spark, sf_dir)
            rows = {r.source_schema_version: r["count"] for r in staged.groupBy("source_schema_version").count().collect()}
            st = (staged.withColumn("first_name", F.concat("first_name", F.lit("\nJo")))
                  .withColumn("school_id", F.concat("school_id", F.lit("\nEast"))))
            n = F.col("student_id").cast("int") + F.unix_date("issue_date")
            steps = []
            for v, lay in LAYOUTS.items():
                files = 4 + rows.get(v, 0) // FILE_ROWS
                name = F.concat(F.lit("s"), F.pmod(n, F.lit(2)) + 1, F.lit(f"/{v}_"), F.pmod(F.floor(n / 2), F.lit(files)))
                out = EX.export_layout(st.where(F.col("source_schema_version") == v).withColumn("part", name), lay,
                                       ntz(S.LOAD_TS), "part")
                steps.append(partial(EX.write_csv_files, out.repartition("part"), "part", f"{root}/parts-{v}", f"{root}/feeds"))
            at_once(spark, *steps)
            _EXPORTED[key] = f"{root}/feeds/*"
    return _EXPORTED[key]


@query("csv_multiline_roundtrip_all")
def csv_multiline_roundtrip_all(spark, sf_dir):
    slots, _ = CSV.read_feeds(spark, multiline_all_feeds(spark, sf_dir))
    return N.normalise(slots).select(*N.CANONICAL)


@query("folder_row_counts_all")
def folder_row_counts_all(spark, sf_dir):
    """SRC-4 over all layouts, with quoted line breaks and equal file names."""
    return CSV.feed_counts(spark, multiline_all_feeds(spark, sf_dir))


# ============================================================================ J12
@query("orphan_schools")
def orphan_schools(spark, sf_dir):
    return XT.orphan_schools(S.staging(spark, sf_dir), XT.school_dimension(table(spark, sf_dir, "nation", "n_nationkey")))


@query("cross_version_dates")
def cross_version_dates(spark, sf_dir):
    return XT.cross_version_dates(S.staging(spark, sf_dir))


@query("dedupe_exact")
def dedupe_exact(spark, sf_dir):
    return XT.dedupe_exact(S.staging(spark, sf_dir))


@query("row_counts_total")
def row_counts_total(spark, sf_dir):
    return XT.row_counts_total(C.source_counts(S.feeds(spark, sf_dir)), S.staging(spark, sf_dir))


# ============================================================================ J3 (streaming)
def streamed_target(spark: SparkSession, sf_dir: str) -> IG.Tables:
    """The staged rows of all layouts delivered as CSV files into one folder and ingested by one stream of file names in
    two runs: files with the layout's column order, files with reversed and extra columns, damaged copies without
    the id column, and a file with a hidden name."""
    from feedrecon.streaming.ingest_stream import start_ingest_stream
    key = S.prepared_key(spark, sf_dir, "stream")
    with S._LOCK:
        if key not in _EXPORTED:
            root = new_work_dir(spark, "stream")
            target, staged = IG.Tables(f"{root}/out"), S.staging(spark, sf_dir)
            part, steps = F.pmod(F.unix_date("issue_date"), F.lit(3)), []
            for v, lay in LAYOUTS.items():
                out = EX.export_layout(staged.where(F.col("source_schema_version") == v).withColumn("part", part), lay, ntz(S.LOAD_TS), "part")
                steps.append(partial(EX.write_csv_files, out.where("part = 0").repartition("part"), "part", f"{root}/parts0-{v}", f"{root}/in", f"{v}_"))
                turned = [F.lit("x").alias("extra_a"), *reversed(lay.columns), F.lit("").alias("extra_b")]
                for i in (1, 2):
                    steps.append(partial(EX.write_csv_files, out.where(F.col("part") == i).select("part", *turned).repartition("part"), "part",
                                         f"{root}/parts{i}-{v}", f"{root}/{'in' if i == 1 else 'later'}", f"{v}_"))
                cut = out.where("part = 0").select("part", *[c for c in lay.columns if c != lay.fingerprint[0]])
                steps.append(partial(EX.write_csv_files, cut.repartition("part"), "part", f"{root}/cut-{v}", f"{root}/later", f"{v}_damaged_"))
                steps.append(partial(EX.write_csv_files, out.where("part = 0").repartition("part"), "part", f"{root}/hid-{v}", f"{root}/in", f"_{v}_hidden_"))
            at_once(spark, *steps)          # one file is one task
            start_ingest_stream(spark, f"{root}/in", target, f"{root}/ckpt", "stream", run_ts=lambda epoch: S.LOAD_TS).awaitTermination()
            EX.move_files(spark, f"{root}/later/*.csv", f"{root}/in")
            start_ingest_stream(spark, f"{root}/in", target, f"{root}/ckpt", "stream", run_ts=lambda epoch: S.LOAD_TS).awaitTermination()
            _EXPORTED[key] = target.root
    return IG.Tables(_EXPORTED[key])


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    return IG.read_staging(spark, streamed_target(spark, sf_dir)).select(*N.CANONICAL)


@query("stream_files")
def stream_files(spark, sf_dir):
    """CLS-4/CLS-5 over the stream: every file it met, recognised or not, with its records."""
    rows = IG.read_files(spark, streamed_target(spark, sf_dir))
    known = F.coalesce("schema_version", F.lit(CL.UNKNOWN))
    return rows.select(F.substring_index("file", "/", -1).alias("file"), known.alias("version"), "mapped_rows", "mapping_errors")


@query("row_counts_unknown_feed")
def row_counts_unknown_feed(spark, sf_dir):
    """CHK-1/CHK-2 with unrecognisable files: part of each layout's records
    arrives in a second file whose header lost the layout's id column. Every
    file is classified from its header; its records are counted; only the
    recognised files are loaded."""
    f = S.feeds(spark, sf_dir)
    damaged = (F.col("k") % DAMAGED_MOD) == 0
    f2 = f.withColumn("feed", F.when(damaged, F.concat(F.lit("credentials_"), F.col("ver"), F.lit("_damaged.csv")))
                      .otherwise(F.col("feed"))).withColumn("damaged", damaged)
    files = f2.groupBy("feed", "ver", "damaged").agg(F.count(F.lit(1)).alias("source_count"))   # one row per file
    header = None
    for v, lay in LAYOUTS.items():
        full = F.array(*[F.lit(c) for c in lay.columns])
        cut = F.array(*[F.lit(c) for c in lay.columns if c != lay.fingerprint[0]])
        h = F.when(F.col("damaged"), cut).otherwise(full)
        header = F.when(F.col("ver") == v, h) if header is None else header.when(F.col("ver") == v, h)
    classified = CL.classify_headers(files.withColumn("header", header))
    counts = classified.select("feed", F.when(F.col("version") != CL.UNKNOWN, F.col("version")).alias("ver"),
                               "source_count")
    staged = N.normalise(S.full_extract(f2.where(~F.col("damaged")))).select(*N.CANONICAL)
    return flat_results(C.reconcile_row_counts(counts, staged))


DAMAGED_MOD = 37


@query("recon_report")
def recon_report(spark, sf_dir):
    """CHK-13: the rendered report, one row per line."""
    return RP.render(_results(spark, sf_dir), "sim_run", f"{S.LOAD_TS:%Y-%m-%d %H:%M:%S} UTC")


@query("latest_records")
def latest_records(spark, sf_dir):
    """P6 option over the two-run staging: the newest row per (layout, source id)."""
    st = IG.read_staging(spark, S.two_runs(spark, sf_dir)).select("run_id", "staged_at", *N.CANONICAL)
    return XT.latest_per_key(st).drop("staged_at")
