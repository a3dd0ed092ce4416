"""DuckDB SQL equivalent of every registered query that SQL can express.

The credential feed is the FIXTURES.md §4 derivation; the mapping rules are
re-stated in plain SQL (independently of the Spark column expressions), so a
match is evidence that both implement the same semantics.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES
# Restated here, so that a wrong value in the code under test cannot stay green.
# Per layout: the columns of a file in order, as (column, canonical field); the columns that identify
# it are all but preferred name and update time. Then id prefix, date pattern, status words (ACTIVE, EXPIRED,
# REVOKED, PENDING), missing token.
# ---------------------------------------------------------------------------
LAYOUTS = {
    "v1": ((("student_id", "id"), ("student_name", "name"), ("schoolId", "school"), ("credentialType", "type"), ("issueDate", "date"),
            ("status", "status"), ("preferred_name", "preferred"), ("updated_at", "updated")),
           "STU", "%Y-%m-%dT%H:%M:%S", ("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), ""),
    "v2": ((("studentId", "id"), ("first_name", "first"), ("last_name", "last"), ("school_id", "school"), ("cred_type", "type"),
            ("issue_date", "date"), ("credentialStatus", "status"), ("preferredName", "preferred"), ("last_modified", "updated")),
           "S", "%m/%d/%Y", ("Active", "Expired", "Revoked", "Pending"), "N/A"),
    "v3": ((("stu_id", "id"), ("firstName", "first"), ("lastName", "last"), ("school_code", "school"), ("credential_category", "type"),
            ("issued_on", "date"), ("status_code", "status"), ("modified_timestamp", "updated")),
           "stu", "%Y-%m-%d", ("ACT", "EXP", "REV", "PND"), ""),
    "v4": ((("learner_id", "id"), ("given_name", "first"), ("family_name", "last"), ("institution_id", "school"), ("type_cd", "type"),
            ("date_issued", "date"), ("cred_status", "status"), ("pref_name", "preferred"), ("last_updated", "updated")),
           "LRN", "%Y-%m-%d", ("A", "E", "R", "P"), "UNKNOWN"),
    "v5": ((("student_id", "id"), ("student_name", "name"), ("school_ref", "school"), ("credential_type", "type"), ("issue_dt", "date"),
            ("status", "status"), ("updated_at", "updated")),
           "STU", "%d-%b-%Y", ("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), ""),
    "v6": ((("id", "id"), ("name_first", "first"), ("name_last", "last"), ("schl_id", "school"), ("credType", "type"),
            ("issuedDate", "date"), ("state", "status"), ("modified", "updated")),
           "", "%Y-%m-%dT%H:%M:%SZ", ("active", "expired", "revoked", "pending"), "null"),
    "v7": ((("student_number", "id"), ("first_name", "first"), ("last_name", "last"), ("school_number", "school"), ("cert_type", "type"),
            ("cert_date", "date"), ("cert_status", "status"), ("preferred_name", "preferred"), ("record_updated", "updated")),
           "SN", "%m-%d-%Y", ("Active", "Expired", "Revoked", "Pending"), ""),
    "v8": ((("student_uid", "id"), ("full_name", "name"), ("school_id", "school"), ("qualification_type", "type"), ("issue_date", "date"),
            ("credential_state", "status"), ("preferred_name", "preferred"), ("updated_at", "updated")),
           "UID", "%Y-%m-%d", ("ISSUED", "EXPIRED", "REVOKED", "DRAFT"), "N/A"),
}
EPOCH = "2000-01-01 00:00:00"
FULL_NAME_VERSIONS = ("v1", "v5", "v8")
PREFERRED_VERSIONS = ("v1", "v2", "v4", "v7", "v8")
MISSING_WORDS = ("", "n/a", "null", "unknown", "none", "na")
STATUS_WORDS = {
    "ACTIVE": "ACTIVE", "EXPIRED": "EXPIRED", "REVOKED": "REVOKED", "PENDING": "PENDING",
    "Active": "ACTIVE", "Expired": "EXPIRED", "Revoked": "REVOKED", "Pending": "PENDING",
    "ACT": "ACTIVE", "EXP": "EXPIRED", "REV": "REVOKED", "PND": "PENDING",
    "A": "ACTIVE", "E": "EXPIRED", "R": "REVOKED", "P": "PENDING",
    "active": "ACTIVE", "expired": "EXPIRED", "revoked": "REVOKED", "pending": "PENDING",
    "ISSUED": "ACTIVE", "DRAFT": "PENDING",
}
ALLOWED_CREDENTIAL_TYPES = (
    "HIGH_SCHOOL_DIPLOMA", "GED", "CERTIFICATE_OF_COMPLETION", "HONORS_DIPLOMA", "ADVANCED_DIPLOMA",
    "VOCATIONAL_CERTIFICATE", "AP_CREDIT", "DUAL_ENROLLMENT", "SPECIAL_EDUCATION_DIPLOMA",
    "ALTERNATIVE_DIPLOMA",
)
ALLOWED_STATUSES = ("ACTIVE", "EXPIRED", "REVOKED", "PENDING")
NULL_THRESHOLDS = (
    ("student_id", 0.0, "FAIL"), ("first_name", 0.0, "FAIL"), ("last_name", 0.0, "FAIL"), ("school_id", 0.0, "FAIL"),
    ("credential_type", 0.0, "FAIL"), ("issue_date", 1.0, "WARNING"), ("status", 0.0, "FAIL"),
    ("preferred_name", 100.0, "WARNING"),
)

FEED = r"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS ck, c_mktsegment AS seg, substr(c_name, 10) AS sur, c_nationkey AS nk,
         CAST(1 + o_orderkey % 8 AS INT) AS v,
         CASE WHEN o_orderkey % 31 = 0 THEN 3 WHEN o_orderstatus = 'O' THEN 1
              WHEN o_orderstatus = 'F' THEN 2 ELSE 4 END AS si,
         CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d,
         CASE (o_custkey + CASE WHEN o_orderkey % 53 = 2 THEN 1 ELSE 0 END) % 10
           WHEN 0 THEN 'HIGH_SCHOOL_DIPLOMA' WHEN 1 THEN 'GED' WHEN 2 THEN 'CERTIFICATE_OF_COMPLETION'
           WHEN 3 THEN 'HONORS_DIPLOMA' WHEN 4 THEN 'ADVANCED_DIPLOMA' WHEN 5 THEN 'VOCATIONAL_CERTIFICATE'
           WHEN 6 THEN 'AP_CREDIT' WHEN 7 THEN 'DUAL_ENROLLMENT' WHEN 8 THEN 'SPECIAL_EDUCATION_DIPLOMA'
           ELSE 'ALTERNATIVE_DIPLOMA' END AS typ
  FROM orders JOIN customer ON o_custkey = c_custkey
), parts AS (
  SELECT *, CAST(d AS VARCHAR) AS iso, CAST(CAST(d + CAST(k % 91 AS INT) AS DATE) AS VARCHAR) AS upd,
         lpad(CAST(extract(MONTH FROM d) AS VARCHAR), 2, '0') AS mm,
         lpad(CAST(extract(DAY FROM d) AS VARCHAR), 2, '0') AS dd,
         CAST(extract(YEAR FROM d) AS VARCHAR) AS yyyy,
         CASE extract(MONTH FROM d) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May'
           WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'Dec' END AS mon,
         CASE si WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'EXPIRED' WHEN 3 THEN 'REVOKED' ELSE 'PENDING' END AS st
  FROM base
), copies AS (
  SELECT *, 1 AS copy_no FROM parts
  UNION ALL
  SELECT *, 2 AS copy_no FROM parts WHERE k % 173 = 4
), feed0 AS (
SELECT k, copy_no, concat('v', CAST(v AS VARCHAR)) AS ver,
  CASE WHEN k % 307 = 5 THEN '' ELSE concat(CASE WHEN k % 311 <> 12 AND k % 19 = 3 THEN '  ' ELSE '' END,
    CASE v WHEN 1 THEN 'STU' WHEN 2 THEN 'S' WHEN 3 THEN 'stu' WHEN 4 THEN 'LRN' WHEN 5 THEN 'STU'
           WHEN 6 THEN '' WHEN 7 THEN 'SN' ELSE 'UID' END,
    CASE WHEN k % 311 = 12 THEN '12' ELSE CAST(100000 + ck AS VARCHAR) END,
    CASE WHEN k % 311 <> 12 AND k % 19 = 3 THEN ' ' ELSE '' END) END AS raw_student_id,
  CASE WHEN v IN (1, 5, 8) THEN CASE WHEN k % 263 = 7 THEN seg WHEN k % 29 = 4 THEN concat(seg, ' Van ', sur)
    ELSE concat(seg, ' ', sur) END END AS raw_full_name,
  CASE WHEN v NOT IN (1, 5, 8) THEN seg END AS raw_first_name,
  CASE WHEN v NOT IN (1, 5, 8) THEN sur END AS raw_last_name,
  CASE WHEN k % 401 = 3 THEN '' ELSE concat('DIST', lpad(CAST(nk AS VARCHAR), 3, '0'), '-SCH',
    lpad(CAST(CASE WHEN k % 97 = 1 THEN 999 ELSE ck % 30 END AS VARCHAR), 3, '0')) END AS raw_school_id,
  CASE WHEN k % 223 = 9 THEN 'bogus type' WHEN v IN (2, 7) THEN lower(replace(typ, '_', ' ')) WHEN v = 4 THEN replace(typ, '_', '-') ELSE typ END AS raw_type,
  CASE WHEN k % 211 = 7 THEN 'not-a-date' ELSE
    CASE v WHEN 1 THEN concat(iso, 'T00:00:00') WHEN 2 THEN concat(mm, '/', dd, '/', yyyy)
           WHEN 5 THEN concat(dd, '-', mon, '-', yyyy) WHEN 6 THEN concat(iso, 'T00:00:00Z')
           WHEN 7 THEN concat(mm, '-', dd, '-', yyyy) ELSE iso END END AS raw_issue_date,
  CASE WHEN k % 101 = 9 THEN 'BOGUS' ELSE
    CASE v WHEN 3 THEN CASE si WHEN 1 THEN 'ACT' WHEN 2 THEN 'EXP' WHEN 3 THEN 'REV' ELSE 'PND' END
           WHEN 4 THEN CASE si WHEN 1 THEN 'A' WHEN 2 THEN 'E' WHEN 3 THEN 'R' ELSE 'P' END
           WHEN 2 THEN concat(substr(st, 1, 1), lower(substr(st, 2)))
           WHEN 7 THEN concat(substr(st, 1, 1), lower(substr(st, 2)))
           WHEN 6 THEN lower(st)
           WHEN 8 THEN CASE si WHEN 1 THEN 'ISSUED' WHEN 4 THEN 'DRAFT' ELSE st END
           ELSE st END END AS raw_status,
  CASE WHEN v IN (3, 5, 6) THEN NULL WHEN k % 5 < 2 THEN seg
       WHEN v IN (2, 8) THEN 'N/A' WHEN v = 4 THEN 'UNKNOWN' ELSE '' END AS raw_preferred,
  CASE WHEN k % 131 = 6 THEN '' WHEN k % 139 = 10 THEN '1999-12-31T00:00:00' ELSE concat(upd, 'T00:00:00') END AS raw_updated_at
FROM copies
), feed AS (
  SELECT *, concat('credentials_', ver, '.csv') AS feed FROM feed0
)"""


def _trim(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '^\s+|\s+$', '', 'g')"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_STATUS_CASE = "CASE t_status " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_WORDS.items()) + " ELSE 'UNKNOWN' END"

# lenient update time (watermark parser): drop Z, T -> ' ', cut at first '.', ISO date [+ hh[:mm[:ss]]]
_UPD = r"""CASE WHEN regexp_full_match(u_s, '[0-9]{4}-[0-9]{2}-[0-9]{2}(.[0-9]{2}(:[0-9]{2}(:[0-9]{2})?)?)?')
  THEN try_cast(substr(u_s, 1, 10) || ' ' || CASE length(u_s) WHEN 10 THEN '00:00:00'
       WHEN 13 THEN substr(u_s, 12, 2) || ':00:00' WHEN 16 THEN substr(u_s, 12, 5) || ':00'
       ELSE substr(u_s, 12, 8) END AS TIMESTAMP) END"""


def _tag_ctes(source: str = "feed") -> str:
    return f"""
trimmed AS (
  SELECT *,
    {_trim('raw_student_id')} AS t_id,
    {_trim('raw_full_name')} AS t_full,
    {_trim('raw_issue_date')} AS t_date,
    {_trim('raw_status')} AS t_status,
    {_trim('raw_preferred')} AS t_pref,
    {_trim('raw_type')} AS t_type,
    string_split_regex({_trim('raw_full_name')}, '\\s+') AS words
  FROM {source}
), tagged0 AS (
  SELECT *,
    coalesce(nullif(regexp_replace(t_id, '[^0-9]', '', 'g'), ''), t_id) AS student_id,
    CASE WHEN ver IN {_in(FULL_NAME_VERSIONS)} THEN
      CASE WHEN t_full = '' THEN '' WHEN len(words) = 1 THEN t_full
           ELSE array_to_string(list_slice(words, 1, len(words) - 1), ' ') END
      ELSE {_trim('raw_first_name')} END AS first_name,
    CASE WHEN ver IN {_in(FULL_NAME_VERSIONS)} THEN
      CASE WHEN t_full = '' OR len(words) = 1 THEN '' ELSE words[len(words)] END
      ELSE {_trim('raw_last_name')} END AS last_name,
    CASE WHEN ver IN {_in(PREFERRED_VERSIONS)} AND lower(t_pref) NOT IN {_in(MISSING_WORDS)} THEN t_pref END AS preferred_name,
    {_trim('raw_school_id')} AS school_id,
    translate(upper(t_type), ' -', '__') AS credential_type,
    CAST(coalesce(try_strptime(t_date, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(t_date, '%Y-%m-%dT%H:%M:%S'),
                  try_strptime(t_date, '%Y-%m-%d'), try_strptime(t_date, '%m/%d/%Y'),
                  try_strptime(t_date, '%m-%d-%Y'), try_strptime(t_date, '%d-%b-%Y')) AS DATE) AS issue_date,
    {_STATUS_CASE} AS status,
    ver AS source_schema_version,
    t_id AS source_student_id
  FROM trimmed
), tagged1 AS (
  SELECT *,
    concat_ws(',', CASE WHEN raw_student_id IS NULL OR raw_student_id = '' THEN 'missing_student_id' END,
                   CASE WHEN raw_school_id IS NULL OR raw_school_id = '' THEN 'missing_school_id' END,
                   CASE WHEN issue_date IS NULL THEN 'unparseable_issue_date' END) AS reasons_txt
  FROM tagged0
), tagged AS (
  SELECT *, CASE WHEN reasons_txt <> '' THEN split_part(reasons_txt, ',', 1) END AS reason FROM tagged1
), mapped AS (
  SELECT * FROM tagged WHERE reason IS NULL
), acc AS (  -- a full first load: nothing updated before the epoch (ISO texts order like times)
  SELECT * FROM mapped WHERE raw_updated_at = '' OR raw_updated_at > '2000-01-01T00:00:00'
)"""


CANON = ("student_id, first_name, last_name, preferred_name, school_id, credential_type, issue_date, status, "
         "source_schema_version, source_student_id")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


BASE = _with(FEED, _tag_ctes())

ORACLE: dict[str, str] = {}

# ============================================================================ J2
for _v in LAYOUTS:
    ORACLE[f"normalise_{_v}"] = f"{BASE}\nSELECT {CANON} FROM mapped WHERE source_schema_version = '{_v}'"
ORACLE["normalise_all"] = f"{BASE}\nSELECT {CANON} FROM acc"
ORACLE["normalise_names"] = f"{BASE}\nSELECT k, copy_no, source_schema_version, first_name, last_name FROM tagged"
ORACLE["normalise_preferred"] = f"{BASE}\nSELECT k, copy_no, source_schema_version, raw_preferred, preferred_name FROM tagged"
ORACLE["normalise_dates"] = f"{BASE}\nSELECT k, copy_no, source_schema_version, raw_issue_date, issue_date FROM tagged"
ORACLE["normalise_ids"] = f"{BASE}\nSELECT k, copy_no, source_schema_version, student_id, source_student_id FROM tagged"
ORACLE["normalise_status"] = (f"{BASE}\nSELECT source_schema_version, raw_status, status, count(*) AS rows "
                              "FROM tagged GROUP BY ALL")
ORACLE["normalise_codes"] = (f"{BASE}\nSELECT source_schema_version, raw_type, credential_type, count(*) AS rows "
                             "FROM tagged GROUP BY ALL")
ORACLE["quarantine_rows"] = (f"{BASE}\nSELECT k, copy_no, source_schema_version, source_student_id, reason, "
                             "reasons_txt AS reasons FROM tagged WHERE reason IS NOT NULL")
ORACLE["quarantine_by_reason"] = (f"{BASE}\nSELECT source_schema_version, reason, count(*) AS rows "
                                  "FROM tagged WHERE reason IS NOT NULL GROUP BY ALL")

# ============================================================================ J4
ORACLE["staged_counts"] = f"{BASE}\nSELECT source_schema_version, count(*) AS cnt FROM acc GROUP BY 1"


def _fmt_int(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _fmt_pct(x: str) -> str:
    return f"format('{{:.2f}}', CAST({x} AS DOUBLE))"


def _row_counts(tol: float) -> str:
    t = repr(float(tol))
    return f"""{BASE},
src AS (SELECT feed, ver, count(*) AS source_count FROM feed GROUP BY feed, ver),
stg AS (SELECT source_schema_version AS ver, count(*) AS staged_count FROM acc GROUP BY 1),
j AS (SELECT feed, src.ver, source_count, coalesce(staged_count, 0) AS staged_count,
             coalesce(staged_count, 0) - source_count AS delta FROM src LEFT JOIN stg ON src.ver = stg.ver),
j2 AS (SELECT *, CASE WHEN source_count > 0 THEN abs(delta / source_count * 100) ELSE 0.0 END AS delta_pct FROM j)
SELECT 1 AS ordinal, 1 AS seq, 'ROW_RECONCILIATION' AS check_type,
  'Row count: ' || ver || ' (' || feed || ')' AS check_name,
  CASE WHEN delta = 0 THEN 'PASS' WHEN delta_pct <= {t} THEN 'WARNING' ELSE 'FAIL' END AS status,
  'FAIL' AS severity,
  CASE WHEN delta = 0 THEN 'source=' || {_fmt_int('source_count')} || ', staged=' || {_fmt_int('staged_count')} || ', delta=0'
       ELSE 'source=' || {_fmt_int('source_count')} || ', staged=' || {_fmt_int('staged_count')} || ', delta='
            || CASE WHEN delta >= 0 THEN '+' ELSE '' END || {_fmt_int('delta')} || ' (' || {_fmt_pct('delta_pct')}
            || '% — ' || CASE WHEN delta_pct <= {t} THEN 'within ' ELSE 'exceeds ' END || '{t}% tolerance)' END AS detail,
  CAST(source_count AS VARCHAR) AS expected, CAST(staged_count AS VARCHAR) AS actual, '' AS sample_values
FROM j2"""


ORACLE["row_counts"] = _row_counts(0.0)
ORACLE["row_counts_tolerance"] = _row_counts(1.0)

# ============================================================================ J5
_NP_COLS = CANON.split(", ")


def _missing(c: str) -> str:
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) = '')"


ORACLE["null_profile"] = f"{BASE},\ntot AS (SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (WHERE {_missing(c)}) AS n{i}" for i, c in enumerate(_NP_COLS)) + " FROM acc)\n" + \
    "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS pos, '{c}' AS \"column\", total, n{i} AS null_count, "
        f"CASE WHEN total > 0 THEN n{i} / total * 100 ELSE 0.0 END AS null_pct FROM tot"
        for i, c in enumerate(_NP_COLS))


def _null_assertions(where: str = "") -> str:
    tot = (f"tot AS (SELECT count(*) AS total, " + ", ".join(
        f"count(*) FILTER (WHERE {_missing(c)}) AS n{i}" for i, (c, _, _) in enumerate(NULL_THRESHOLDS))
        + f" FROM acc {where})")
    arms = []
    for i, (c, lim, sev) in enumerate(NULL_THRESHOLDS):
        p = f"(CASE WHEN total > 0 THEN n{i} / total * 100 ELSE 0.0 END)"
        l = repr(float(lim))
        arms.append(
            f"SELECT 2 AS ordinal, {i + 1} AS seq, 'NULL_ASSERTIONS' AS check_type, 'Null check: {c}' AS check_name, "
            f"CASE WHEN {p} <= {l} THEN 'PASS' ELSE '{sev}' END AS status, '{sev}' AS severity, "
            f"'null_count=' || {_fmt_int(f'n{i}')} || ', null_pct=' || {_fmt_pct(p)} || "
            f"CASE WHEN {p} <= {l} THEN '% (threshold={l}%)' ELSE '% EXCEEDS threshold={l}%' END AS detail, "
            f"'≤{l}%' AS expected, {_fmt_pct(p)} || '%' AS actual, '' AS sample_values FROM tot WHERE total > 0")
    arms.append("SELECT 2 AS ordinal, 1 AS seq, 'NULL_ASSERTIONS' AS check_type, 'Null assertions: staging table' AS check_name, "
                "'FAIL' AS status, 'FAIL' AS severity, 'Staging table is empty — no records to check' AS detail, "
                "CAST(NULL AS VARCHAR) AS expected, CAST(NULL AS VARCHAR) AS actual, '' AS sample_values FROM tot WHERE total = 0")
    return f"{BASE},\n{tot}\n" + "\nUNION ALL\n".join(arms)


ORACLE["null_assertions"] = _null_assertions()
ORACLE["null_assertions_empty"] = _null_assertions("WHERE issue_date > DATE '9999-01-01'")

# ============================================================================ J6
_BAD_ID = r"NOT coalesce(regexp_full_match(student_id, '\p{Nd}{6}'), false)"

_ID_ARM = f"""SELECT 3 AS ordinal, 1 AS seq, 'REFERENTIAL_INTEGRITY' AS check_type,
  'student_id: format validation (6-digit numeric)' AS check_name,
  CASE WHEN invalid = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'FAIL' AS severity,
  CASE WHEN invalid = 0 THEN 'All ' || {_fmt_int('total')} || ' student_id values match expected format'
       ELSE {_fmt_int('invalid')} || ' student_id values do not match expected format' END AS detail,
  CAST(NULL AS VARCHAR) AS expected, CASE WHEN invalid > 0 THEN CAST(invalid AS VARCHAR) END AS actual,
  CASE WHEN invalid > 0 THEN (SELECT coalesce(string_agg(student_id, ',' ORDER BY student_id), '')
        FROM (SELECT student_id FROM acc WHERE {_BAD_ID} ORDER BY student_id LIMIT 10)) ELSE '' END AS sample_values
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {_BAD_ID}) AS invalid FROM acc)"""


def _allowed_arm(column: str, allowed, seq: int, fail: str) -> str:
    if column == "credential_type":
        ok = f"All credential_type values are in the allowed set ({len(allowed)} types)"
        bad = " records have unrecognised credential_type values: "
    else:
        ok = f"All {column} values are in canonical set {sorted(allowed)}".replace("'", "''")
        bad = f" records have non-canonical {column} values: "
    off = f"(SELECT {column} AS value, count(*) AS cnt FROM acc GROUP BY 1 HAVING NOT coalesce({column} IN {_in(allowed)}, false))"
    return f"""SELECT 3 AS ordinal, {seq} AS seq, 'REFERENTIAL_INTEGRITY' AS check_type,
  '{column}: allowed values check' AS check_name,
  CASE WHEN n_values = 0 THEN 'PASS' ELSE '{fail}' END AS status, '{fail}' AS severity,
  CASE WHEN n_values = 0 THEN '{ok}'
       ELSE {_fmt_int('n_rows')} || '{bad}' || '[' || (SELECT coalesce(string_agg('''' || value || '''', ', ' ORDER BY value), '')
             FROM (SELECT value FROM {off} ORDER BY value LIMIT 5)) || ']' END AS detail,
  CAST(NULL AS VARCHAR) AS expected, CASE WHEN n_values > 0 THEN CAST(n_rows AS VARCHAR) END AS actual,
  CASE WHEN n_values > 0 THEN (SELECT coalesce(string_agg(value, ',' ORDER BY value), '')
        FROM (SELECT value FROM {off} ORDER BY value LIMIT 10)) ELSE '' END AS sample_values
FROM (SELECT count(*) AS n_values, coalesce(sum(cnt), 0) AS n_rows FROM {off})"""


ORACLE["id_format"] = f"{BASE}\n{_ID_ARM}"
ORACLE["type_histogram"] = f"{BASE}\nSELECT credential_type AS value, count(*) AS cnt FROM acc GROUP BY 1"
ORACLE["status_histogram"] = f"{BASE}\nSELECT status AS value, count(*) AS cnt FROM acc GROUP BY 1"
_TYPE_ARM = _allowed_arm("credential_type", ALLOWED_CREDENTIAL_TYPES, 2, "FAIL")
_STATUS_ARM = _allowed_arm("status", ALLOWED_STATUSES, 3, "WARNING")
ORACLE["allowed_types"] = f"{BASE}\n{_TYPE_ARM}"
ORACLE["allowed_status"] = f"{BASE}\n{_STATUS_ARM}"

# ============================================================================ J7
_DUP_GROUPS = ("(SELECT student_id, school_id, credential_type, issue_date, count(*) AS cnt FROM acc "
               "GROUP BY 1, 2, 3, 4 HAVING count(*) > 1)")
ORACLE["exact_duplicates"] = f"{BASE}\nSELECT * FROM {_DUP_GROUPS}"
ORACLE["duplicate_excess"] = (f"{BASE}\nSELECT count(*) AS duplicate_groups, CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS excess_rows "
                              f"FROM {_DUP_GROUPS}")
_DUP_ARM = f"""SELECT 4 AS ordinal, 1 AS seq, 'DUPLICATE_DETECTION' AS check_type,
  'Exact duplicates (same student_id + credential + date)' AS check_name,
  CASE WHEN groups = 0 THEN 'PASS' ELSE 'WARNING' END AS status, 'WARNING' AS severity,
  CASE WHEN groups = 0 THEN 'No exact duplicate records found across all schema versions'
       ELSE {_fmt_int('groups')} || ' student_ids appear in multiple schema versions with identical data ('
            || {_fmt_int('excess')} || ' excess rows)' END AS detail,
  CAST(NULL AS VARCHAR) AS expected, CASE WHEN groups > 0 THEN CAST(groups AS VARCHAR) END AS actual,
  CASE WHEN groups > 0 THEN (SELECT coalesce(string_agg(student_id, ',' ORDER BY student_id, school_id, credential_type, issue_date), '')
        FROM (SELECT * FROM {_DUP_GROUPS} ORDER BY student_id, school_id, credential_type, issue_date LIMIT 10)) ELSE '' END AS sample_values
FROM (SELECT count(*) AS groups, coalesce(sum(cnt - 1), 0) AS excess FROM {_DUP_GROUPS})"""

# ============================================================================ J8/J9
_SCHOOL_CONFLICTS = "(SELECT student_id FROM acc GROUP BY student_id HAVING count(DISTINCT school_id) > 1)"
_MULTI = "(SELECT student_id FROM acc GROUP BY student_id HAVING count(DISTINCT source_schema_version) > 1)"
_MULTI_TYPE = (f"(SELECT student_id FROM acc WHERE student_id IN {_MULTI} GROUP BY student_id "
               "HAVING count(DISTINCT credential_type) > 1)")
ORACLE["school_conflicts"] = f"{BASE}\nSELECT * FROM {_SCHOOL_CONFLICTS}"
ORACLE["multi_version_ids"] = f"{BASE}\nSELECT * FROM {_MULTI}"
ORACLE["cross_version_consistency"] = f"{BASE}\nSELECT * FROM {_MULTI_TYPE}"
_CONFLICT_ARM = f"""SELECT 4 AS ordinal, 2 AS seq, 'DUPLICATE_DETECTION' AS check_type,
  'Conflict duplicates (same student_id, different school_id)' AS check_name,
  CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'FAIL' AS severity,
  CASE WHEN n = 0 THEN 'No student_ids with conflicting school_id found'
       ELSE {_fmt_int('n')} || ' student_ids appear with >1 distinct school_id — requires investigation before Gold load' END AS detail,
  CAST(NULL AS VARCHAR) AS expected, CASE WHEN n > 0 THEN CAST(n AS VARCHAR) END AS actual,
  CASE WHEN n > 0 THEN (SELECT coalesce(string_agg(student_id, ',' ORDER BY student_id), '')
        FROM (SELECT student_id FROM {_SCHOOL_CONFLICTS} ORDER BY student_id LIMIT 10)) ELSE '' END AS sample_values
FROM (SELECT count(*) AS n FROM {_SCHOOL_CONFLICTS})"""
_CONSISTENCY_ARM = f"""SELECT 5 AS ordinal, 1 AS seq, 'CROSS_VERSION_CONSISTENCY' AS check_type,
  CASE WHEN m = 0 THEN 'Students appearing in multiple schema versions' ELSE 'Cross-version: credential_type consistency' END AS check_name,
  CASE WHEN m = 0 OR n = 0 THEN 'PASS' ELSE 'WARNING' END AS status, 'WARNING' AS severity,
  CASE WHEN m = 0 THEN 'No student_ids appear across multiple schema versions'
       WHEN n = 0 THEN {_fmt_int('m')} || ' students appear in multiple schema versions — all have consistent credential_type'
       ELSE {_fmt_int('n')} || ' students have different credential_type values across schema versions — review before deduplication' END AS detail,
  CAST(NULL AS VARCHAR) AS expected, CASE WHEN m > 0 AND n > 0 THEN CAST(n AS VARCHAR) END AS actual,
  CASE WHEN m > 0 AND n > 0 THEN (SELECT coalesce(string_agg(student_id, ',' ORDER BY student_id), '')
        FROM (SELECT student_id FROM {_MULTI_TYPE} ORDER BY student_id LIMIT 10)) ELSE '' END AS sample_values
FROM (SELECT (SELECT count(*) FROM {_MULTI}) AS m, (SELECT count(*) FROM {_MULTI_TYPE}) AS n)"""

# ============================================================================ J10
_RC = _row_counts(0.0)
_RC_ARM = _RC[_RC.index("\nSELECT 1 AS ordinal"):]
_RC_CTES = _RC[len(BASE):_RC.index("\nSELECT 1 AS ordinal")]
_NA = _null_assertions()
_NA_CTES = _NA[len(BASE):_NA.index("\nSELECT 2 AS ordinal")]
_NA_ARMS = _NA[_NA.index("\nSELECT 2 AS ordinal"):]
RESULTS = (f"{BASE}{_RC_CTES}{_NA_CTES},\nresults AS (\n{_RC_ARM}\nUNION ALL\n{_NA_ARMS}\nUNION ALL\n{_ID_ARM}\n"
           f"UNION ALL\n{_TYPE_ARM}\nUNION ALL\n{_STATUS_ARM}\nUNION ALL\n{_DUP_ARM}\nUNION ALL\n{_CONFLICT_ARM}\n"
           f"UNION ALL\n{_CONSISTENCY_ARM})")
ORACLE["recon_results"] = f"{RESULTS}\nSELECT * FROM results"
_OVERALL = """SELECT CASE WHEN failed > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS overall_status,
  passed, warnings, failed, total FROM (SELECT count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status = 'WARNING') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failed,
  count(*) AS total FROM results)"""
ORACLE["recon_overall"] = f"{RESULTS}\n{_OVERALL}"
ORACLE["recon_gate"] = (f"{RESULTS}\nSELECT overall_status, CASE WHEN overall_status IN ('PASS', 'PASS_WITH_WARNINGS') "
                        f"THEN 0 ELSE 1 END AS exit_code, overall_status IN ('PASS', 'PASS_WITH_WARNINGS') AS publish "
                        f"FROM ({_OVERALL})")
ORACLE["sample_values"] = (f"{RESULTS}\nSELECT check_name, CAST(i - 1 AS INT) AS pos, "
                           "string_split(sample_values, ',')[i] AS sample FROM results, range(1, 11) AS t(i) "
                           "WHERE sample_values <> '' AND i <= len(string_split(sample_values, ','))")

# ============================================================================ J1
def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


_COLUMNS = {v: [c for c, _ in l[0]] for v, l in LAYOUTS.items()}
_FINGERPRINTS = {v: [c for c, field in l[0] if field not in ("preferred", "updated")] for v, l in LAYOUTS.items()}
_COLS_CASE = "CASE k % 8 " + " ".join(f"WHEN {i} THEN {_list(c)}" for i, c in enumerate(_COLUMNS.values())) + " END"
_NEXT_CASE = "CASE (k + 1) % 8 " + " ".join(f"WHEN {i} THEN {_list(c)}" for i, c in enumerate(_COLUMNS.values())) + " END"
_FP0_CASE = "CASE k % 8 " + " ".join(f"WHEN {i} THEN '{c[0]}'" for i, c in enumerate(_FINGERPRINTS.values())) + " END"
_FP_VALUES = ", ".join(f"('{v}', '{c}', {len(f)}, {i})" for i, (v, f) in enumerate(_FINGERPRINTS.items()) for c in f)
MANIFEST = f"""WITH h0 AS (
  SELECT o_orderkey AS k, {_COLS_CASE} AS cols, {_FP0_CASE} AS fp0, {_NEXT_CASE} AS nxt FROM orders
), h1 AS (SELECT k, CASE WHEN k % 37 = 0 THEN list_filter(cols, lambda x: x <> fp0) ELSE cols END AS h, nxt FROM h0
), h2 AS (SELECT k, CASE WHEN k % 41 = 0 THEN list_concat(h, nxt) ELSE h END AS h FROM h1
), h3 AS (SELECT k, CASE WHEN k % 3 = 0 THEN list_append(h, 'extra_col') ELSE h END AS h FROM h2
), manifest AS (SELECT k AS feed, CASE WHEN k % 43 = 0 THEN list_transform(h, lambda x: upper(x)) ELSE h END AS header FROM h3
), lng AS (SELECT feed, unnest(header) AS col FROM manifest
), fp(version, col, fp_size, pos) AS (VALUES {_FP_VALUES}
), m AS (SELECT feed, version, fp_size, pos FROM lng JOIN fp ON lng.col = fp.col
         GROUP BY feed, version, fp_size, pos HAVING count(DISTINCT lng.col) = fp_size
), r AS (SELECT feed, version, count(*) OVER (PARTITION BY feed) AS matches,
                row_number() OVER (PARTITION BY feed ORDER BY fp_size DESC, pos) AS rn FROM m
), classified AS (
  SELECT manifest.feed, header, coalesce(r.version, 'UNKNOWN') AS version, coalesce(r.matches, 0) AS matches
  FROM manifest LEFT JOIN r ON manifest.feed = r.feed AND r.rn = 1
)"""
ORACLE["feed_classify"] = f"{MANIFEST}\nSELECT feed, version FROM classified"
ORACLE["feed_classify_long"] = f"{MANIFEST}\nSELECT feed, version, matches FROM classified"
ORACLE["feed_classify_ambiguous"] = f"{MANIFEST}\nSELECT feed, matches, version FROM classified WHERE matches > 1"
_KNOWN = "Known fingerprints:\n" + "\n".join(f"  {v}: {sorted(f)}" for v, f in _FINGERPRINTS.items())
_MESSAGE = ("'Unknown schema version. Column set does not match any of the 8 known fingerprints.' || chr(10) || 'Columns found: [' || "
            "array_to_string(list_transform(list_sort(header), lambda x: chr(39) || x || chr(39)), ', ') || ']' || chr(10) || '"
            + _KNOWN.replace("'", "' || chr(39) || '").replace("\n", "' || chr(10) || '") + "'")
ORACLE["feed_unknown"] = (f"{MANIFEST}\nSELECT feed, array_to_string(list_sort(header), ',') AS sorted_columns, {_MESSAGE} AS message "
                          "FROM classified WHERE version = 'UNKNOWN'")

# ============================================================================ J3
def _ts(d) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def _fmt_ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S')"


from feedrecon.plans.scenarios import LATE_MOD, LATE_REM, RUN1_TS, RUN2_TS, RUN3_TS, LOAD_TS  # noqa: E402

_U_S = "split_part(replace(replace(raw_updated_at, 'Z', ''), 'T', ' '), '.', 1)"
_U = _UPD.replace("u_s", _U_S)
BASE_U = BASE.replace("FROM feed\n), tagged0", "FROM feed\n), tagged0").replace(
    "    string_split_regex(", f"    {_U} AS u,\n    string_split_regex(", 1)
E0, T1, T2, T3 = f"TIMESTAMP '{EPOCH}'", _ts(RUN1_TS), _ts(RUN2_TS), _ts(RUN3_TS)


def _runs(reset: tuple[str, ...] = ()) -> str:
    keep = f" AND ver NOT IN {_in(reset)}" if reset else ""
    return f"""{BASE_U},
r1 AS (SELECT *, 'run1' AS run_id FROM tagged
       WHERE (u IS NULL OR u <= {T1}) AND k % {LATE_MOD} <> {LATE_REM} AND (u IS NULL OR u > {E0})),
d1 AS (SELECT ver, count(*) FILTER (WHERE reason IS NULL) AS mapped, count(*) FILTER (WHERE reason IS NOT NULL) AS errors
       FROM r1 GROUP BY ver),
wm1 AS (SELECT ver, {T1} AS wm FROM d1 WHERE (errors = 0 OR mapped > 0){keep}),
del2 AS (SELECT t.*, (u IS NULL OR u > coalesce(w.wm, {E0})) AS ext FROM tagged t LEFT JOIN wm1 w ON t.ver = w.ver
         WHERE u IS NULL OR u <= {T2}),
r2 AS (SELECT *, 'run2' AS run_id FROM del2 WHERE ext),
d2 AS (SELECT ver, count(*) FILTER (WHERE reason IS NULL) AS mapped, count(*) FILTER (WHERE reason IS NOT NULL) AS errors
       FROM r2 GROUP BY ver),
a1 AS (SELECT ver, mapped FROM d1 WHERE (errors = 0 OR mapped > 0){keep}),
a2 AS (SELECT ver, mapped FROM d2 WHERE errors = 0 OR mapped > 0),
st AS (SELECT coalesce(a2.ver, a1.ver) AS schema_version,
              CASE WHEN a2.ver IS NOT NULL THEN {T2} ELSE {T1} END AS lp,
              coalesce(a2.mapped, a1.mapped) AS cnt,
              CASE WHEN a1.ver IS NOT NULL THEN {T1} ELSE {T2} END AS created
       FROM a1 FULL JOIN a2 ON a1.ver = a2.ver)"""


_STATE = (f"SELECT schema_version, {_fmt_ts('lp')} AS last_processed_at, cnt AS last_run_row_count, "
          f"{_fmt_ts('lp')} AS last_run_timestamp")
ORACLE["watermark_state"] = f"{_runs()}\n{_STATE} FROM st"
ORACLE["watermark_upsert"] = f"{_runs()}\n{_STATE}, {_fmt_ts('created')} AS created_at FROM st"
ORACLE["watermark_reset"] = f"{_runs(('v3', 'v5'))}\n{_STATE}, {_fmt_ts('created')} AS created_at FROM st"
ORACLE["watermark_advance"] = (f"{_runs()}\nSELECT ver AS schema_version, mapped AS mapped_rows, errors AS mapping_errors, "
                               "(errors = 0 OR mapped > 0) AS advanced FROM d2")
ORACLE["ingest_append"] = f"{_runs()}\nSELECT run_id, {CANON} FROM r1 WHERE reason IS NULL"
ORACLE["ingest_two_runs"] = (f"{_runs()}\nSELECT run_id, {CANON} FROM r1 WHERE reason IS NULL "
                             f"UNION ALL SELECT run_id, {CANON} FROM r2 WHERE reason IS NULL")
ORACLE["full_reload"] = (f"{BASE_U}\nSELECT 'run3' AS run_id, {CANON} FROM tagged "
                         f"WHERE (u IS NULL OR u <= {T3}) AND (u IS NULL OR u > {E0}) AND reason IS NULL")
_SUMMARY = """SELECT ver AS schema_version, feed AS file, count(*) AS total_rows,
  count(*) FILTER (WHERE ext) AS extracted_rows, count(*) FILTER (WHERE ext AND reason IS NULL) AS mapped_rows,
  count(*) FILTER (WHERE ext AND reason IS NOT NULL) AS mapping_errors,
  count(*) FILTER (WHERE u IS NULL) AS no_update_time_rows,
  count(*) - count(*) FILTER (WHERE ext) AS skipped_rows FROM del2 GROUP BY ver, feed"""
ORACLE["run_summary"] = f"{_runs()}\n{_SUMMARY}"
ORACLE["run_totals"] = (f"{_runs()}\nSELECT CAST(sum(mapped_rows) AS BIGINT) AS staged, CAST(sum(skipped_rows) AS BIGINT) AS skipped, "
                        "CAST(sum(mapping_errors) AS BIGINT) AS errors, CASE WHEN sum(mapping_errors) = 0 THEN 'COMPLETED' "
                        f"ELSE 'COMPLETED WITH WARNINGS' END AS status FROM ({_SUMMARY})")
_RAW = ("raw_student_id, raw_full_name, raw_first_name, raw_last_name, raw_school_id, raw_type, raw_issue_date, raw_status, "
        "raw_preferred, raw_updated_at")
ORACLE["quarantine_table"] = (f"{_runs()}\nSELECT run_id, source_schema_version, source_student_id, reason, {_RAW} FROM r1 "
                              f"WHERE reason IS NOT NULL UNION ALL SELECT run_id, source_schema_version, source_student_id, "
                              f"reason, {_RAW} FROM r2 WHERE reason IS NOT NULL")
ORACLE["incremental_extract"] = (f"{BASE_U}\nSELECT k, copy_no, ver, raw_updated_at FROM tagged WHERE u IS NULL OR "
                                 f"u > CASE WHEN ver IN ('v1', 'v2', 'v3', 'v4') THEN {T1} ELSE {E0} END")


# ============================================================================ J11
def _export_select(version: str) -> str:
    columns, prefix, pattern, words, missing = LAYOUTS[version]
    status = "CASE status " + " ".join(f"WHEN '{c}' THEN '{w}'" for c, w in zip(("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), words)) + " ELSE status END"
    cells = {"id": f"'{prefix}' || student_id", "name": "first_name || ' ' || last_name", "first": "first_name", "last": "last_name",
             "school": "school_id", "type": "credential_type", "date": f"strftime(issue_date, '{pattern}')", "status": status,
             "preferred": f"coalesce(preferred_name, '{missing}')", "updated": f"'{LOAD_TS:%Y-%m-%dT%H:%M:%S}'"}
    return ", ".join(f'{cells[field]} AS "{c}"' for c, field in columns)


for _v in LAYOUTS:
    ORACLE[f"export_{_v}"] = f"{BASE}\nSELECT {_export_select(_v)} FROM acc"


def _roundtrip_loss(version: str) -> str:
    columns, prefix, *_ = LAYOUTS[version]
    conds = ["NOT regexp_full_match(student_id, '[0-9]+')" if prefix else "student_id = ''"]
    if any(field == "name" for _, field in columns):
        conds.append(r"(regexp_matches(last_name, '\s') OR regexp_matches(first_name, '^\s|\s$|\s\s') "
                     r"OR (first_name = '' AND last_name <> '') OR (last_name = '' AND regexp_matches(first_name, '\s')))")
    conds.append("school_id = ''")
    return " OR ".join(conds)


ORACLE["export_roundtrip"] = f"{BASE}\n" + "\nUNION ALL\n".join(
    f"SELECT '{v}' AS layout, count(*) AS rows, count(*) FILTER (WHERE {_roundtrip_loss(v)}) AS mismatches FROM acc" for v in LAYOUTS)
ORACLE["csv_roundtrip"] = f"{BASE}\nSELECT {CANON} FROM acc"

# ============================================================================ J12
ORACLE["orphan_schools"] = (f"{BASE},\ndim AS (SELECT 'DIST' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '-SCH' || "
                            "lpad(CAST(s AS VARCHAR), 3, '0') AS school_id FROM nation, range(0, 30) AS t(s))\n"
                            "SELECT school_id, count(*) AS rows, count(DISTINCT student_id) AS students FROM acc "
                            "WHERE school_id NOT IN (SELECT school_id FROM dim) GROUP BY school_id")
ORACLE["cross_version_dates"] = (f"{BASE}\nSELECT student_id FROM acc WHERE student_id IN {_MULTI} "
                                 "GROUP BY student_id HAVING count(DISTINCT issue_date) > 1")
ORACLE["dedupe_exact"] = (f"{BASE}\nSELECT {CANON} FROM (SELECT *, row_number() OVER (PARTITION BY student_id, school_id, "
                          "credential_type, issue_date ORDER BY source_schema_version, source_student_id, first_name, "
                          "last_name, preferred_name NULLS FIRST, status) AS rn FROM acc) WHERE rn = 1")
ORACLE["row_counts_total"] = f"""{BASE},
src AS (SELECT ver, count(*) AS source_count FROM feed GROUP BY ver),
stg AS (SELECT source_schema_version AS ver, count(*) AS staged_count FROM acc GROUP BY 1),
j AS (SELECT coalesce(src.ver, stg.ver) AS ver, coalesce(source_count, 0) AS source_count,
             coalesce(staged_count, 0) AS staged_count FROM src FULL JOIN stg ON src.ver = stg.ver)
SELECT ver AS schema_version, source_count, staged_count, staged_count - source_count AS delta FROM j
UNION ALL
SELECT 'TOTAL', CAST(sum(source_count) AS BIGINT), CAST(sum(staged_count) AS BIGINT),
       CAST(sum(staged_count) - sum(source_count) AS BIGINT) FROM j"""
ORACLE["stream_ingest"] = f"{BASE}\nSELECT {CANON} FROM acc"
_JO = "first_name || chr(10) || 'Jo' AS first_name"
_BROKEN = "(issue_date - DATE '1970-01-01') % 3 = 0"
_EAST = f"CASE WHEN {_BROKEN} THEN school_id || ',\"East\"' || chr(10) || 'wing' ELSE school_id END AS school_id"
ORACLE["csv_multiline_roundtrip"] = (
    f"{BASE}\nSELECT 'plain' AS folder, {CANON} FROM acc UNION ALL SELECT 'broken', {CANON.replace('school_id', _EAST, 1)} FROM acc")
ORACLE["folder_row_counts"] = (
    f"{BASE}\nSELECT folder || '/' || source_schema_version || '.csv' AS feed, source_schema_version AS ver, count(*) AS source_count "
    "FROM acc, (VALUES ('plain'), ('broken')) f(folder) GROUP BY ALL")
_SCHOOL_ALL = "school_id || chr(10) || 'East' AS school_id"
# A full name is split at white space, line breaks included: one word leaves its last part to the break's.
_FULL = f"source_schema_version IN {_in(FULL_NAME_VERSIONS)}"
_FIRST_ALL = (f"CASE WHEN NOT {_FULL} THEN first_name || chr(10) || 'Jo' WHEN last_name = '' THEN first_name "
              "ELSE first_name || ' Jo' END AS first_name")
_LAST_ALL = f"CASE WHEN {_FULL} AND last_name = '' THEN 'Jo' ELSE last_name END AS last_name"
ORACLE["csv_multiline_roundtrip_all"] = (
    f"{BASE}\nSELECT student_id, {_FIRST_ALL}, {_LAST_ALL}, preferred_name, {_SCHOOL_ALL}, credential_type, issue_date, status, "
    "source_schema_version, source_student_id FROM acc")
_PLACED = (
    f"{BASE}, placed AS (SELECT source_schema_version AS ver, CAST(student_id AS INT) + (issue_date - DATE '1970-01-01') AS n, "
    "4 + count(*) OVER (PARTITION BY source_schema_version) // 16384 AS files FROM acc),\n"
    "named AS (SELECT 's' || CAST(n % 2 + 1 AS VARCHAR) AS folder, ver || '_' || CAST((n // 2) % files AS VARCHAR) || '.csv' AS name, ver FROM placed)\n")
ORACLE["folder_row_counts_all"] = f"{_PLACED}SELECT folder || '/' || name AS feed, ver, count(*) AS source_count FROM named GROUP BY ALL"
ORACLE["feed_manifest"] = (f"{_PLACED}SELECT folder, ver AS version, CAST(1 AS BIGINT) AS matches, count(DISTINCT name) AS files, "
                           "min(name) AS first, max(name) AS last FROM named GROUP BY ALL")
ORACLE["feed_manifest_damaged"] = (f"{BASE}\nSELECT DISTINCT source_schema_version AS folder, source_schema_version AS version, "
                                   "CAST(1 AS BIGINT) AS matches FROM acc UNION ALL "
                                   "SELECT DISTINCT source_schema_version || '_damaged', 'UNKNOWN', CAST(0 AS BIGINT) FROM acc")
_THIRD = "(issue_date - DATE '1970-01-01') % 3"
ORACLE["stream_files"] = (
    f"{BASE}\nSELECT source_schema_version || '_' || CAST({_THIRD} AS VARCHAR) || '.csv' AS file, source_schema_version AS version, "
    "count(*) AS mapped_rows, CAST(0 AS BIGINT) AS mapping_errors FROM acc GROUP BY ALL UNION ALL "
    "SELECT DISTINCT source_schema_version || '_damaged_0.csv', 'UNKNOWN', CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM acc "
    f"WHERE {_THIRD} = 0 UNION ALL "
    "SELECT DISTINCT '_' || source_schema_version || '_hidden_0.csv', 'UNKNOWN', CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM acc "
    f"WHERE {_THIRD} = 0")
# Files by layout and year of update; the second run opens those with a record without update time or past the first one's time.
_BANDS = f"""{BASE_U},
banded AS (SELECT *, ver || '_' || CASE WHEN u IS NULL OR k % 17 = 3 THEN 'none' ELSE CAST(extract(YEAR FROM u) AS VARCHAR) END || '.csv' AS file
           FROM tagged),
one AS (SELECT *, u IS NULL OR u > {E0} AS ext1, u IS NULL OR u > {T1} AS ext2 FROM banded),
f1 AS (SELECT file, count(*) AS total_rows, count(*) FILTER (ext1) AS extracted1, count(*) FILTER (ext2) AS extracted2,
              count(*) FILTER (u IS NULL) AS no_update_time_rows, max(u) AS newest,
              count(*) FILTER (u IS NULL) > 0 OR max(u) > {T1} AS again FROM one GROUP BY file)"""
ORACLE["files_skipped"] = (
    f"{_BANDS}\nSELECT 'run1' AS run_id, file, true AS opened, total_rows, extracted1 AS extracted_rows, total_rows - extracted1 AS skipped_rows, "
    f"no_update_time_rows, {_fmt_ts('newest')} AS newest FROM f1 UNION ALL "
    f"SELECT 'run2', file, again, total_rows, extracted2, total_rows - extracted2, no_update_time_rows, {_fmt_ts('newest')} FROM f1")
ORACLE["files_two_runs"] = (f"{_BANDS}\nSELECT 'run1' AS run_id, {CANON} FROM one WHERE ext1 AND reason IS NULL "
                            f"UNION ALL SELECT 'run2', {CANON} FROM one WHERE ext2 AND reason IS NULL")
ORACLE["recon_results_kept"] = (
    f"{_BANDS},\nacc2 AS (SELECT * FROM one WHERE ext1 AND reason IS NULL UNION ALL SELECT * FROM one WHERE ext2 AND reason IS NULL),\n"
    "feed2 AS (SELECT ver, file AS feed FROM one)" + ORACLE["recon_results"][len(BASE):].replace("FROM acc", "FROM acc2").replace("FROM feed ", "FROM feed2 "))
# The report's fixed texts, restated. Samples arrive joined by commas.
ORACLE["recon_report"] = f"""
WITH r0 AS ({ORACLE["recon_results"]}),
r1 AS (SELECT *, CASE WHEN ordinal <> 1 THEN NULL WHEN regexp_full_match(check_name, 'Row count: \\S+ \\(.*\\)')
         THEN regexp_extract(check_name, '^Row count: \\S+ \\((.*)\\)$', 1) ELSE substr(check_name, 12) END AS file FROM r0),
r2 AS (SELECT *, row_number() OVER w AS pos, lag(check_type) OVER w AS before FROM r1
       WINDOW w AS (ORDER BY ordinal, seq, file NULLS FIRST, check_name)),
b AS (SELECT pos, list_concat(
        CASE WHEN before IS NULL OR before <> check_type THEN ['', check_type, repeat('-', 74)] ELSE [] END,
        ['  [' || rpad(status, 7, ' ') || '] ' || CASE status WHEN 'PASS' THEN '✓' WHEN 'FAIL' THEN '✗' WHEN 'WARNING' THEN '⚠' ELSE '?' END
           || '  ' || check_name, repeat(' ', 13) || detail],
        CASE WHEN sample_values = '' THEN []
             ELSE [repeat(' ', 13) || 'Sample: [' || array_to_string(string_split(sample_values, ',')[1:5], ', ') || ']'] END) AS ls FROM r2),
o AS (SELECT count(*) FILTER (WHERE status = 'PASS') AS p, count(*) FILTER (WHERE status = 'WARNING') AS w,
             count(*) FILTER (WHERE status = 'FAIL') AS f FROM r0),
a AS (SELECT 0 AS pos, ['', repeat('=', 74), 'MIGRATION — RECONCILIATION REPORT', 'Run timestamp  : 2024-01-01 00:00:00 UTC',
                        'Pipeline run   : sim_run', repeat('=', 74)] AS ls
      UNION ALL SELECT pos, ls FROM b
      UNION ALL SELECT 1000000000, ['', repeat('=', 74), 'OVERALL RESULT : ' || CASE WHEN f > 0 THEN 'FAIL' WHEN w > 0
                        THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END, '  Passed   : ' || p, '  Warnings : ' || w, '  Failed   : ' || f,
                        repeat('=', 74)] FROM o),
l AS (SELECT pos, unnest(ls) AS line, generate_subscripts(ls, 1) AS sub FROM a)
SELECT CAST(row_number() OVER (ORDER BY pos, sub) AS INTEGER) AS line_no, line FROM l
"""
ORACLE["row_counts_unknown_feed"] = f"""{BASE},
f2 AS (SELECT *, k % 37 = 0 AS damaged,
              CASE WHEN k % 37 = 0 THEN 'credentials_' || ver || '_damaged.csv' ELSE feed END AS feed2 FROM feed),
src AS (SELECT feed2 AS feed, CASE WHEN damaged THEN NULL ELSE ver END AS ver, count(*) AS source_count
        FROM f2 GROUP BY ALL),
stg AS (SELECT source_schema_version AS ver, count(*) AS staged_count FROM acc WHERE k % 37 <> 0 GROUP BY 1),
j AS (SELECT feed, src.ver, source_count, coalesce(staged_count, 0) AS staged_count,
             coalesce(staged_count, 0) - source_count AS delta FROM src LEFT JOIN stg ON src.ver = stg.ver),
j2 AS (SELECT *, CASE WHEN source_count > 0 THEN abs(delta / source_count * 100) ELSE 0.0 END AS delta_pct FROM j)
SELECT 1 AS ordinal, 1 AS seq, 'ROW_RECONCILIATION' AS check_type,
  CASE WHEN ver IS NULL THEN 'Row count: ' || feed ELSE 'Row count: ' || ver || ' (' || feed || ')' END AS check_name,
  CASE WHEN ver IS NULL THEN 'FAIL' WHEN delta = 0 THEN 'PASS' WHEN delta_pct <= 0.0 THEN 'WARNING' ELSE 'FAIL' END AS status,
  'FAIL' AS severity,
  CASE WHEN ver IS NULL THEN 'Could not detect schema version for ' || feed || ' — skipped'
       WHEN delta = 0 THEN 'source=' || {_fmt_int('source_count')} || ', staged=' || {_fmt_int('staged_count')} || ', delta=0'
       ELSE 'source=' || {_fmt_int('source_count')} || ', staged=' || {_fmt_int('staged_count')} || ', delta='
            || CASE WHEN delta >= 0 THEN '+' ELSE '' END || {_fmt_int('delta')} || ' (' || {_fmt_pct('delta_pct')}
            || '% — ' || CASE WHEN delta_pct <= 0.0 THEN 'within ' ELSE 'exceeds ' END || '0.0% tolerance)' END AS detail,
  CASE WHEN ver IS NOT NULL THEN CAST(source_count AS VARCHAR) END AS expected,
  CASE WHEN ver IS NOT NULL THEN CAST(staged_count AS VARCHAR) END AS actual, '' AS sample_values
FROM j2"""
_STAGED_TWO = (f"SELECT run_id, {CANON} FROM r1 WHERE reason IS NULL "
               f"UNION ALL SELECT run_id, {CANON} FROM r2 WHERE reason IS NULL")
_REST = [c for c in CANON.split(", ") if c not in ("source_schema_version", "source_student_id")]
ORACLE["latest_records"] = (f"{_runs()},\nstaged2 AS ({_STAGED_TWO})\nSELECT run_id, {CANON} FROM ("
                            "SELECT *, row_number() OVER (PARTITION BY source_schema_version, source_student_id "
                            "ORDER BY run_id DESC, " + ", ".join(f"{c} DESC NULLS LAST" for c in _REST)
                            + ") AS rn FROM staged2) WHERE rn = 1")
