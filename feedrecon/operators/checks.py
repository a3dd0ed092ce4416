"""J4–J9 — reconciliation checks as DataFrame jobs.

Each check returns a *results* DataFrame with the common schema
``ordinal, seq, check_type, check_name, status, severity, detail, expected,
actual, sample_values`` (``ordinal`` = check family in suite order, ``seq`` =
position inside the family). Counts come from aggregates that run with
partial (map-side) aggregation; "more than one distinct value" is tested as
``min <> max`` of 64-bit hashes, so one hash aggregation per student, with
fixed-width buffers, answers school, version and type conflicts together. Samples are the ten smallest offending values
(``orderBy().limit(10)``, a bounded top-k), never a collected group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.functions import rules as R

RESULT_COLUMNS = ("ordinal", "seq", "check_type", "check_name", "status", "severity", "detail", "expected",
                  "actual", "sample_values")
SAMPLE_LIMIT = 10

# ---------------------------------------------------------------------------
# FIXED VALUES — thresholds, allowed sets and tolerance of the legacy suite.
# ---------------------------------------------------------------------------
# (column, max null-or-empty percent, severity), in suite order.
NULL_THRESHOLDS = (
    ("student_id", 0.0, "FAIL"),
    ("first_name", 0.0, "FAIL"),
    ("last_name", 0.0, "FAIL"),
    ("school_id", 0.0, "FAIL"),
    ("credential_type", 0.0, "FAIL"),
    ("issue_date", 1.0, "WARNING"),
    ("status", 0.0, "FAIL"),
    ("preferred_name", 100.0, "WARNING"),
)
ALLOWED_CREDENTIAL_TYPES = (
    "HIGH_SCHOOL_DIPLOMA", "GED", "CERTIFICATE_OF_COMPLETION", "HONORS_DIPLOMA", "ADVANCED_DIPLOMA",
    "VOCATIONAL_CERTIFICATE", "AP_CREDIT", "DUAL_ENROLLMENT", "SPECIAL_EDUCATION_DIPLOMA",
    "ALTERNATIVE_DIPLOMA",
)
ALLOWED_STATUSES = ("ACTIVE", "EXPIRED", "REVOKED", "PENDING")
# Python's \d is any Unicode decimal digit.
ID_FORMAT = r"^\p{Nd}{6}$"
DEFAULT_TOLERANCE_PCT = 0.0
DUPLICATE_KEYS = ("student_id", "school_id", "credential_type", "issue_date")

ROW, NULLS, INTEGRITY, DUPLICATES, CONSISTENCY = (
    "ROW_RECONCILIATION", "NULL_ASSERTIONS", "REFERENTIAL_INTEGRITY", "DUPLICATE_DETECTION",
    "CROSS_VERSION_CONSISTENCY")


# ----------------------------------------------------------------------------- helpers
def sql_int(x: str) -> str:
    return f"format_number(CAST({x} AS BIGINT), 0)"


def sql_signed(x: str) -> str:
    return f"concat(CASE WHEN {x} >= 0 THEN '+' ELSE '' END, format_number(CAST({x} AS BIGINT), 0))"


def sql_pct(x: str) -> str:
    return f"format_number(CAST({x} AS DOUBLE), '0.00')"


def sql_py_list(arr: str, n: int = 5) -> str:
    """First n strings rendered like a Python list literal: ['a', 'b']."""
    q = sql_str("'")
    return f"concat('[', array_join(transform(slice({arr}, 1, {n}), x -> concat({q}, x, {q})), ', '), ']')"


def sql_str(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def result_sql(ordinal: int, seq: int, check_type: str, check_name: str, status: str, severity: str,
               detail: str, expected: str = "CAST(NULL AS STRING)", actual: str = "CAST(NULL AS STRING)",
               samples: str = "CAST(array() AS ARRAY<STRING>)") -> list[str]:
    """The common result columns as SQL expressions (one ``selectExpr``)."""
    return [f"{ordinal} AS ordinal", f"{seq} AS seq", f"{sql_str(check_type)} AS check_type",
            f"{check_name} AS check_name", f"{status} AS status", f"{severity} AS severity", f"{detail} AS detail",
            f"{expected} AS expected", f"{actual} AS actual", f"{samples} AS sample_values"]


def with_samples(stats: DataFrame, offenders: DataFrame, value: str, *order: str) -> DataFrame:
    """Attach ``samples`` (the ten smallest offending values) to a one-row
    stats frame without a join: the bounded top-k rows are unioned with the
    stats row and folded by one global aggregate."""
    order = order or (value,)
    top = offenders.orderBy(*order).limit(SAMPLE_LIMIT).select(F.col(value).cast("string").alias("_s"), *order)
    s_cols = [c for c in stats.columns]
    tagged_stats = stats.select(*s_cols, F.lit(None).cast("string").alias("_s"),
                                F.struct(*[F.lit(None).cast(offenders.schema[o].dataType).alias(o) for o in order]).alias("_o"),
                                F.lit(True).alias("_is_stats"))
    tagged_top = top.select(*[F.lit(None).cast(stats.schema[c].dataType).alias(c) for c in s_cols], "_s",
                            F.struct(*order).alias("_o"), F.lit(False).alias("_is_stats"))
    u = tagged_stats.unionByName(tagged_top)
    picks = F.array_sort(F.collect_list(F.when(~F.col("_is_stats"), F.struct(F.col("_o"), F.col("_s")))))
    return u.agg(*[F.max_by(F.col(c), F.col("_is_stats")).alias(c) for c in s_cols],
                 F.transform(picks, lambda x: x["_s"]).alias("samples"))


def result_struct_sql(*args, **kwargs) -> str:
    """The same as one struct, for several rows in one array."""
    pairs = [x.rsplit(" AS ", 1) for x in result_sql(*args, **kwargs)]
    return "named_struct(" + ", ".join(f"'{name}', {expr}" for expr, name in pairs) + ")"


# ----------------------------------------------------------------------------- J4
def source_counts(feeds: DataFrame) -> DataFrame:
    """Records per delivered feed: ``feed, ver, source_count`` (``ver`` NULL for
    a feed whose layout is unknown)."""
    return feeds.groupBy("feed", "ver").agg(F.count(F.lit(1)).alias("source_count"))


def staged_counts(staging: DataFrame) -> DataFrame:
    """AGG-1: rows per version, ordered by version."""
    return (staging.groupBy("source_schema_version").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("source_schema_version"))


def reconcile_row_counts(feed_counts: DataFrame, staging: DataFrame,
                         tolerance_pct: float = DEFAULT_TOLERANCE_PCT) -> DataFrame:
    """CHK-1/CHK-2: one row per feed (by feed name). Known feeds compare their
    record count with the staged total of their version; unknown feeds FAIL."""
    return row_count_results(feed_counts, staging.groupBy("source_schema_version").agg(F.count(F.lit(1)).alias("cnt")), tolerance_pct)


def row_count_results(feed_counts: DataFrame, staged_counts: DataFrame, tolerance_pct: float = DEFAULT_TOLERANCE_PCT) -> DataFrame:
    """The same from staged rows per version (``source_schema_version, cnt``).
    Both inputs are already aggregated (one row per feed / per version), so
    the join is between two small frames."""
    staged = staged_counts.select(F.col("source_schema_version").alias("ver"), F.col("cnt").alias("staged_count"))
    j = feed_counts.join(staged, "ver", "left").withColumn("staged_count", F.coalesce("staged_count", F.lit(0)))
    tol, tol_txt = f"{float(tolerance_pct)!r}D", repr(float(tolerance_pct))
    delta = "(staged_count - source_count)"
    pct_ = f"(CASE WHEN source_count > 0 THEN abs({delta} / source_count * 100) ELSE 0.0D END)"
    head = f"'source=', {sql_int('source_count')}, ', staged=', {sql_int('staged_count')}, ', delta='"
    detail = (f"CASE WHEN ver IS NULL THEN concat('Could not detect schema version for ', feed, ' — skipped') "
              f"WHEN {delta} = 0 THEN concat({head}, '0') "
              f"ELSE concat({head}, {sql_signed(delta)}, ' (', {sql_pct(pct_)}, '% — ', "
              f"CASE WHEN {pct_} <= {tol} THEN 'within ' ELSE 'exceeds ' END, '{tol_txt}% tolerance)') END")
    status = (f"CASE WHEN ver IS NULL THEN 'FAIL' WHEN {delta} = 0 THEN 'PASS' "
              f"WHEN {pct_} <= {tol} THEN 'WARNING' ELSE 'FAIL' END")
    name = "CASE WHEN ver IS NULL THEN concat('Row count: ', feed) ELSE concat('Row count: ', ver, ' (', feed, ')') END"
    # All row-count rows share seq 1; reports order them by check name.
    return j.selectExpr(*result_sql(1, 1, ROW, name, status, "'FAIL'", detail,
                                    "CASE WHEN ver IS NOT NULL THEN CAST(source_count AS STRING) END",
                                    "CASE WHEN ver IS NOT NULL THEN CAST(staged_count AS STRING) END"))


# ----------------------------------------------------------------------------- J5
def _missing_sql(c: str) -> str:
    return f"(`{c}` IS NULL OR CAST(`{c}` AS STRING) = '')"


def _null_counts(df: DataFrame, columns) -> DataFrame:
    """One global aggregate: ``total`` and ``n<i>`` = NULL-or-empty count of column i."""
    return df.agg(F.expr("count(1) AS total"),
                  *[F.expr(f"count_if({_missing_sql(c)}) AS n{i}") for i, c in enumerate(columns)])


def null_profile(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """AGG-3 in one pass: ``column, total, null_count, null_pct`` per column
    (NULL-or-empty counted), from a single global aggregate unpivoted to rows."""
    rows = "explode(array(" + ", ".join(
        f"named_struct('pos', {i + 1}, 'column', {sql_str(c)}, 'null_count', n{i})" for i, c in enumerate(columns)) + ")) AS r"
    return (_null_counts(df, columns).selectExpr("total", rows)
            .selectExpr("r.pos AS pos", "r.column AS column", "total", "r.null_count AS null_count",
                        "CASE WHEN total > 0 THEN r.null_count / total * 100 ELSE 0.0D END AS null_pct"))


def null_rows_sql(thresholds, total: str, counts: list[str]) -> str:
    """CHK-3/CHK-4 result rows (SQL array of structs) from SQL for the total and the null counts."""
    per_col = []
    for i, (c, limit, severity) in enumerate(thresholds):
        p = f"(CASE WHEN {total} > 0 THEN {counts[i]} / {total} * 100 ELSE 0.0D END)"
        lim = repr(float(limit))
        ok = f"({p} <= {lim}D)"
        detail = (f"concat('null_count=', format_number({counts[i]}, 0), ', null_pct=', format_number({p}, '0.00'), "
                  f"CASE WHEN {ok} THEN '% (threshold={lim}%)' ELSE '% EXCEEDS threshold={lim}%' END)")
        per_col.append(result_struct_sql(2, i + 1, NULLS, sql_str(f"Null check: {c}"), f"CASE WHEN {ok} THEN 'PASS' ELSE '{severity}' END",
                                         f"'{severity}'", detail, sql_str(f"≤{lim}%"), f"concat(format_number({p}, '0.00'), '%')"))
    empty = result_struct_sql(2, 1, NULLS, "'Null assertions: staging table'", "'FAIL'", "'FAIL'",
                              "'Staging table is empty — no records to check'")
    return f"CASE WHEN {total} = 0 THEN array({empty}) ELSE array({', '.join(per_col)}) END"


def null_assertions(staging: DataFrame, thresholds=NULL_THRESHOLDS) -> DataFrame:
    """CHK-3/CHK-4: one row per column against its threshold; a single FAIL
    row when staging is empty. Everything comes from one aggregate; the
    per-column rows are one SQL expression (built JVM-side in one call)."""
    one = _null_counts(staging, [c for c, _, _ in thresholds])
    rows = null_rows_sql(thresholds, "total", [f"n{i}" for i in range(len(thresholds))])
    return one.selectExpr(f"explode({rows}) AS r").select("r.*")


# ----------------------------------------------------------------------------- J6
def id_format_sql(total: str, invalid: str, samples: str, column: str = "student_id") -> tuple:
    """CHK-5's result from SQL for the row total, the invalid rows and their samples."""
    return (3, 1, INTEGRITY, sql_str(f"{column}: format validation (6-digit numeric)"),
            f"CASE WHEN {invalid} = 0 THEN 'PASS' ELSE 'FAIL' END", "'FAIL'",
            f"CASE WHEN {invalid} = 0 THEN concat('All ', {sql_int(total)}, {sql_str(f' {column} values match expected format')}) "
            f"ELSE concat({sql_int(invalid)}, {sql_str(f' {column} values do not match expected format')}) END",
            "CAST(NULL AS STRING)", f"CASE WHEN {invalid} > 0 THEN CAST({invalid} AS STRING) END",
            f"CASE WHEN {invalid} > 0 THEN {samples} ELSE CAST(array() AS ARRAY<STRING>) END")


def check_id_format(staging: DataFrame, column: str = "student_id", pattern: str = ID_FORMAT) -> DataFrame:
    """CHK-5: values not matching the six-digit format."""
    bad = ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))
    stats = staging.agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("invalid"))
    s = with_samples(stats, staging.where(bad), column)
    return s.selectExpr(*result_sql(*id_format_sql("total", "invalid", "samples", column)))


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """AGG-4: ``value, cnt`` per distinct value (hash aggregate, map-side combine)."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("cnt"))


# ---------------------------------------------------------------------------
# FIXED VALUES — check names and texts below (here, and in null_rows_sql, id_format_sql, duplicate_results,
# school_conflicts_sql and cross_version_sql) must equal the legacy report's. Column -> passed, failed; any other
# column uses the second pair.
# ---------------------------------------------------------------------------
ALLOWED_TEXTS = {
    "credential_type": ("All credential_type values are in the allowed set ({n} types)",
                        " records have unrecognised credential_type values: "),
    None: ("All {column} values are in canonical set {values}", " records have non-canonical {column} values: "),
}


def allowed_sql(column: str, allowed, seq: int, fail_status: str, rows: str, values: str, samples: str) -> tuple:
    """CHK-6/CHK-7's result from SQL for the offending rows, distinct values and samples."""
    ok_text, bad_text = (t.format(n=len(allowed), column=column, values=sorted(allowed))
                         for t in ALLOWED_TEXTS.get(column, ALLOWED_TEXTS[None]))
    return (3, seq, INTEGRITY, sql_str(f"{column}: allowed values check"),
            f"CASE WHEN {values} = 0 THEN 'PASS' ELSE '{fail_status}' END", f"'{fail_status}'",
            f"CASE WHEN {values} = 0 THEN {sql_str(ok_text)} "
            f"ELSE concat({sql_int(rows)}, {sql_str(bad_text)}, {sql_py_list(samples)}) END",
            "CAST(NULL AS STRING)", f"CASE WHEN {values} > 0 THEN CAST({rows} AS STRING) END",
            f"CASE WHEN {values} > 0 THEN {samples} ELSE CAST(array() AS ARRAY<STRING>) END")


def check_allowed(staging: DataFrame, column: str, allowed, seq: int, fail_status: str) -> DataFrame:
    """CHK-6/CHK-7: values outside the allowed set, from the value histogram.
    The histogram has one row per distinct value, so the samples are distinct."""
    hist = value_histogram(staging, column)
    bad = ~F.coalesce(F.col("value").isin(*allowed), F.lit(False))
    offenders = hist.where(bad)
    stats = offenders.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("invalid_rows"),
                          F.count(F.lit(1)).alias("invalid_values"))
    s = with_samples(stats, offenders, "value")
    return s.selectExpr(*result_sql(*allowed_sql(column, allowed, seq, fail_status, "invalid_rows", "invalid_values", "samples")))


def _one_row(facts: DataFrame) -> DataFrame:
    """``kind, value, cnt`` → one row holding a map from kind to (rows ``n``,
    distinct ``vals``, ten smallest values as ``dist`` and, repeated as
    often as they occur, as ``smp``). Both aggregates read the same shuffle;
    the ten are limited before it (window group limit)."""
    sums = facts.groupBy("kind").agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("vals"))
    order = Window.partitionBy("kind").orderBy(F.col("value").asc_nulls_first())
    top = (facts.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= SAMPLE_LIMIT)
           .groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("rn", "value", "cnt"))).alias("top")))
    spread = F.flatten(F.transform("top", lambda x: F.array_repeat(x["value"], F.least(x["cnt"], F.lit(SAMPLE_LIMIT)).cast("int"))))
    entry = F.struct("kind", F.struct("n", "vals", F.slice(spread, 1, SAMPLE_LIMIT).alias("smp"),
                                      F.transform("top", lambda x: x["value"]).alias("dist")))
    return sums.join(top, "kind", "left").agg(F.map_from_entries(F.collect_list(entry)).alias("m"))


def _fact(kind: str, field: str) -> str:
    if field in ("n", "vals"):
        return f"coalesce(try_element_at(m, '{kind}').{field}, 0)"
    return f"coalesce(try_element_at(m, '{kind}').{field}, CAST(array() AS ARRAY<STRING>))"


def value_checks(staging: DataFrame, thresholds=NULL_THRESHOLDS, id_column: str = "student_id", id_pattern: str = ID_FORMAT,
                 allowed=(("credential_type", ALLOWED_CREDENTIAL_TYPES, "FAIL"), ("status", ALLOWED_STATUSES, "WARNING"))) -> DataFrame:
    """CHK-3 to CHK-7 from one scan: every row states its facts (that it is
    one, its missing cells, its offending values), they are counted map-side, and all result rows
    come from the counts. Same rows as the single checks."""
    return value_results(value_facts(staging, thresholds, id_column, id_pattern, allowed), thresholds, id_column, allowed)


def value_facts(staging: DataFrame, thresholds=NULL_THRESHOLDS, id_column: str = "student_id", id_pattern: str = ID_FORMAT,
                allowed=(("credential_type", ALLOWED_CREDENTIAL_TYPES, "FAIL"), ("status", ALLOWED_STATUSES, "WARNING"))) -> DataFrame:
    """``kind, value, cnt``: counted facts of the rows. Counts of parts of a table add up."""
    none = F.lit(None).cast("string")

    def fact(kind, value, when=None):
        f = F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
        return f if when is None else F.when(when, f)

    facts = [fact("total", none), fact("id", F.col(id_column), ~F.coalesce(F.col(id_column).rlike(id_pattern), F.lit(False)))]
    facts += [fact(f"null{i}", none, F.expr(_missing_sql(c))) for i, (c, _, _) in enumerate(thresholds)]
    facts += [fact(f"not{i}", F.col(c), ~F.coalesce(F.col(c).isin(*vals), F.lit(False))) for i, (c, vals, _) in enumerate(allowed)]
    rows = staging.select(F.explode(F.array_compact(F.array(*facts))).alias("f")).select("f.kind", "f.value")
    return rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("cnt"))


def value_results(facts: DataFrame, thresholds=NULL_THRESHOLDS, id_column: str = "student_id",
                  allowed=(("credential_type", ALLOWED_CREDENTIAL_TYPES, "FAIL"), ("status", ALLOWED_STATUSES, "WARNING"))) -> DataFrame:
    """CHK-3 to CHK-7 from counted facts."""
    one = _one_row(facts)
    nulls = null_rows_sql(thresholds, _fact("total", "n"), [_fact(f"null{i}", "n") for i in range(len(thresholds))])
    others = [result_struct_sql(*id_format_sql(_fact("total", "n"), _fact("id", "n"), _fact("id", "smp"), id_column))]
    others += [result_struct_sql(*allowed_sql(c, vals, 2 + i, severity, _fact(f"not{i}", "n"), _fact(f"not{i}", "vals"), _fact(f"not{i}", "dist")))
               for i, (c, vals, severity) in enumerate(allowed)]
    return one.selectExpr(f"explode(concat({nulls}, array({', '.join(others)}))) AS r").select("r.*")


def referential_integrity(staging: DataFrame) -> DataFrame:
    return (check_id_format(staging)
            .unionByName(check_allowed(staging, "credential_type", ALLOWED_CREDENTIAL_TYPES, 2, "FAIL"))
            .unionByName(check_allowed(staging, "status", ALLOWED_STATUSES, 3, "WARNING")))


# ----------------------------------------------------------------------------- J7
def exact_duplicates(df: DataFrame, keys=DUPLICATE_KEYS) -> DataFrame:
    """AGG-6: key groups occurring more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def check_exact_duplicates(staging: DataFrame, keys=DUPLICATE_KEYS) -> DataFrame:
    """CHK-8 (WARNING): number of duplicate groups and excess rows."""
    return duplicate_results(exact_duplicates(staging, keys), keys)


def duplicate_results(groups: DataFrame, keys=DUPLICATE_KEYS) -> DataFrame:
    """CHK-8 from the key groups that occur more than once."""
    stats = groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("excess"))
    s = with_samples(stats, groups, keys[0], *keys)
    return s.selectExpr(*result_sql(
        4, 1, DUPLICATES, "'Exact duplicates (same student_id + credential + date)'",
        "CASE WHEN groups = 0 THEN 'PASS' ELSE 'WARNING' END", "'WARNING'",
        "CASE WHEN groups = 0 THEN 'No exact duplicate records found across all schema versions' "
        f"ELSE concat({sql_int('groups')}, ' student_ids appear in multiple schema versions with identical data (', "
        f"{sql_int('excess')}, ' excess rows)') END",
        actual="CASE WHEN groups > 0 THEN CAST(groups AS STRING) END",
        samples="CASE WHEN groups > 0 THEN samples ELSE CAST(array() AS ARRAY<STRING>) END"))


# ----------------------------------------------------------------------------- J8/J9
PROFILE = {"school_id": "school", "source_schema_version": "version", "credential_type": "type", "issue_date": "date"}
#: All bits of a hash; a test uses fewer, to make values collide.
HASH_BITS = 64


def _hash(c: str, bits: int) -> Column:
    """64-bit hash of a value; null stays null."""
    h = F.xxhash64(c) if bits == 64 else F.pmod(F.xxhash64(c), F.lit(1 << bits))
    return F.when(F.col(c).isNotNull(), h)


def student_hashes(staging: DataFrame, key: str = "student_id", bits: int = HASH_BITS) -> DataFrame:
    """Per student the smallest and the largest hash of each of the ``PROFILE`` columns present (NULLs ignored like
    COUNT(DISTINCT)). One hash aggregate over fixed-width buffers, one exchange; minima and maxima of parts of a
    table combine."""
    return staging.groupBy(key).agg(*[f(_hash(c, bits)).alias(f"{m}_{n}") for c, n in PROFILE.items() if c in staging.columns
                                      for f, m in ((F.min, "min"), (F.max, "max"))])


def hash_flags(hashes: DataFrame, key: str = "student_id") -> DataFrame:
    """``multi_<name>``: more than one distinct hash."""
    names = [n for n in PROFILE.values() if f"min_{n}" in hashes.columns]
    return hashes.select(key, *[F.coalesce(F.col(f"min_{n}") != F.col(f"max_{n}"), F.lit(False)).alias(f"multi_{n}") for n in names])


def colliding_values(values: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """``name, value`` of the distinct values (``name, value``) whose hash another value of the same column shares. Empty, but for
    odds of one in 2^64 a pair."""
    hashed = values.withColumn("hash", _hash("value", bits) if bits != 64 else F.xxhash64("value"))
    shared = hashed.groupBy("name", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "hash")
    return hashed.join(shared, ["name", "hash"], "left_semi").select("name", "value")


def profile_values(staging: DataFrame) -> DataFrame:
    """``name, value``: the distinct values of the ``PROFILE`` columns present, as text."""
    cells = [F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for c, n in PROFILE.items() if c in staging.columns]
    return staging.select(F.explode(F.array(*cells)).alias("v")).select("v.*").where("value IS NOT NULL").distinct()


def student_profile(staging: DataFrame, key: str = "student_id", bits: int = HASH_BITS) -> DataFrame:
    """``key`` and ``multi_school``, ``multi_version``, … : whether the student has more than one distinct value. Different
    hashes are different values; equal hashes are equal values unless two values of the column share one,
    and only for such values (none, as a rule) texts are compared."""
    text = staging.select(key, *[F.col(c).cast("string").alias(c) for c in PROFILE if c in staging.columns])
    flags = hash_flags(student_hashes(text, key, bits), key)
    names = [n for c, n in PROFILE.items() if c in staging.columns]
    shared = colliding_values(profile_values(text), bits)
    cells = [F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for c, n in PROFILE.items() if c in staging.columns]
    differ = (text.select(key, F.explode(F.array(*cells)).alias("v")).select(key, "v.*").join(F.broadcast(shared), ["name", "value"], "left_semi")
              .groupBy(key, "name").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo <> hi")
              .groupBy(key).agg(*[F.max(F.col("name") == n).alias(f"also_{n}") for n in names]))
    return flags.join(F.broadcast(differ), key, "left").select(
        key, *[(F.col(f"multi_{n}") | F.coalesce(F.col(f"also_{n}"), F.lit(False))).alias(f"multi_{n}") for n in names])


def conflicting(staging: DataFrame, key: str, column: str) -> DataFrame:
    """Keys with more than one distinct non-NULL value of ``column``."""
    return (staging.groupBy(key).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
            .where(F.col("lo") != F.col("hi")).select(key))


def school_conflicts_sql(n: str, samples: str) -> tuple:
    """CHK-9's result from SQL for the number of students and their samples."""
    return (4, 2, DUPLICATES, "'Conflict duplicates (same student_id, different school_id)'",
            f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END", "'FAIL'",
            f"CASE WHEN {n} = 0 THEN 'No student_ids with conflicting school_id found' "
            f"ELSE concat({sql_int(n)}, ' student_ids appear with >1 distinct school_id — requires investigation "
            "before Gold load') END",
            "CAST(NULL AS STRING)", f"CASE WHEN {n} > 0 THEN CAST({n} AS STRING) END",
            f"CASE WHEN {n} > 0 THEN {samples} ELSE CAST(array() AS ARRAY<STRING>) END")


def check_school_conflicts(profile: DataFrame) -> DataFrame:
    """CHK-9 (FAIL): students linked to more than one school."""
    off = profile.where("multi_school")
    s = with_samples(off.agg(F.count(F.lit(1)).alias("n")), off, "student_id")
    return s.selectExpr(*result_sql(*school_conflicts_sql("n", "samples")))


def duplicate_detection(staging: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    profile = profile if profile is not None else student_profile(staging)
    return check_exact_duplicates(staging).unionByName(check_school_conflicts(profile))


def cross_version_sql(multi: str, n: str, samples: str) -> tuple:
    """CHK-10/CHK-11's result from SQL for the students in several versions, those that differ, and samples."""
    hit = f"({multi} > 0 AND {n} > 0)"
    return (5, 1, CONSISTENCY,
            f"CASE WHEN {multi} = 0 THEN 'Students appearing in multiple schema versions' "
            "ELSE 'Cross-version: credential_type consistency' END",
            f"CASE WHEN {hit} THEN 'WARNING' ELSE 'PASS' END", "'WARNING'",
            f"CASE WHEN {multi} = 0 THEN 'No student_ids appear across multiple schema versions' "
            f"WHEN {n} = 0 THEN concat({sql_int(multi)}, ' students appear in multiple schema versions — all have "
            "consistent credential_type') "
            f"ELSE concat({sql_int(n)}, ' students have different credential_type values across schema versions — "
            "review before deduplication') END",
            "CAST(NULL AS STRING)", f"CASE WHEN {hit} THEN CAST({n} AS STRING) END",
            f"CASE WHEN {hit} THEN {samples} ELSE CAST(array() AS ARRAY<STRING>) END")


def check_cross_version(profile: DataFrame) -> DataFrame:
    """CHK-10/CHK-11: students in several versions; among them, those with
    more than one credential type (WARNING). A single PASS row when no
    student spans versions."""
    multi = profile.where("multi_version")
    off = multi.where("multi_type")
    stats = multi.agg(F.count(F.lit(1)).alias("multi"), F.count_if(F.col("multi_type")).alias("n"))
    return with_samples(stats, off, "student_id").selectExpr(*result_sql(*cross_version_sql("multi", "n", "samples")))


def student_checks(staging: DataFrame) -> DataFrame:
    """CHK-9 to CHK-11 from one scan and one aggregate per student."""
    return student_results(student_profile(staging.select("student_id", "school_id", "source_schema_version", "credential_type")))


def student_results(profile: DataFrame) -> DataFrame:
    """CHK-9 to CHK-11 from the students' flags."""
    kinds = F.array_compact(F.array(F.when(F.col("multi_school"), F.lit("school")), F.when(F.col("multi_version"), F.lit("multi")),
                                    F.when(F.col("multi_version") & F.col("multi_type"), F.lit("type"))))
    one = _one_row(profile.select(F.explode(kinds).alias("kind"), F.col("student_id").alias("value"), F.lit(1).cast("long").alias("cnt")))
    rows = [result_struct_sql(*school_conflicts_sql(_fact("school", "n"), _fact("school", "smp"))),
            result_struct_sql(*cross_version_sql(_fact("multi", "n"), _fact("type", "n"), _fact("type", "smp")))]
    return one.selectExpr(f"explode(array({', '.join(rows)})) AS r").select("r.*")
