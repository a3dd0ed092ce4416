"""Cell rules as Spark column expressions (Column -> Column).

Every rule here is a composition of built-in functions, so it runs inside
whole-stage codegen on the executors; there is no Python on the row path.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip()/str.split() understand it, derived by rule
# from the Unicode database rather than listed by hand.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
# A run of that whitespace, as a Java regex character class of ranges (each one is a test per character).
WS_RUN = "[" + "".join(f"\\x{{{ord(a):x}}}-\\x{{{ord(a) + n - 1:x}}}" for a, n in (
    (ch, next(n for n in range(1, 99) if chr(ord(ch) + n) not in PY_WHITESPACE))
    for ch in PY_WHITESPACE if chr(ord(ch) - 1) not in PY_WHITESPACE)) + "]+"

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the legacy mapper for correct results.
# ---------------------------------------------------------------------------
# Status spellings (case-sensitive, after trimming) and their canonical word.
STATUS_WORDS = {
    "ACTIVE": "ACTIVE", "EXPIRED": "EXPIRED", "REVOKED": "REVOKED", "PENDING": "PENDING",
    "Active": "ACTIVE", "Expired": "EXPIRED", "Revoked": "REVOKED", "Pending": "PENDING",
    "ACT": "ACTIVE", "EXP": "EXPIRED", "REV": "REVOKED", "PND": "PENDING",
    "A": "ACTIVE", "E": "EXPIRED", "R": "REVOKED", "P": "PENDING",
    "active": "ACTIVE", "expired": "EXPIRED", "revoked": "REVOKED", "pending": "PENDING",
    "ISSUED": "ACTIVE", "DRAFT": "PENDING",
}
UNKNOWN_STATUS = "UNKNOWN"
# Optional-text values treated as missing (compared after trim + lower-case).
MISSING_WORDS = ("", "n/a", "null", "unknown", "none", "na")
# Accepted issue-date formats (legacy order): ISO date-time with Z, ISO
# date-time, ISO date, month/day/year, month-day-year, day-Mon-year. Field
# widths as the legacy parser reads them: 4-digit year, 1-2 digit month, day,
# hour (0-23), minute and second (0-59); literal T/Z and month names in any case. There is no year 0.
_TIME = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]"
ISO_DATE_SHAPE = rf"^(?!0000)[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}(?:[Tt]{_TIME}[Zz]?)?$"
MDY_SHAPE = r"^[0-9]{1,2}([/-])[0-9]{1,2}\1(?!0000)[0-9]{4}$"
DMONY_SHAPE = r"^[0-9]{1,2}-[A-Za-z]{3}-(?!0000)[0-9]{4}$"
MONTH_ABBREVIATIONS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Update-time text accepted by the lenient watermark parser after its clean-up
# (drop every Z, T -> blank, cut at the first dot): ISO date, optionally with
# hour, minute, second.
UPDATED_AT_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(.[0-9]{2}(:[0-9]{2}(:[0-9]{2})?)?)?$"
# Normalised student ids are six digits.
STUDENT_ID_SHAPE = r"^[0-9]{6}$"


def ntz(ts) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock, independent of the session time zone)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim all Unicode whitespace from both ends (Python ``str.strip``)."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def blank_to_empty(c: Column | str) -> Column:
    """A cell that is absent or NULL reads as the empty string."""
    return F.coalesce(_c(c), F.lit(""))


def parse_issue_date(c: Column | str) -> Column:
    """Trimmed text -> DATE if it has one of the six accepted shapes and is a
    real date (not 30 Feb, not year 0); else NULL. The shapes are mutually
    exclusive and leave out year 0; once a shape is validated its parts are rearranged to
    ``y-m-d`` and converted with the plain string-to-date cast (no
    per-row formatter, no split by a pattern that is compiled for each row, no part parsed twice)."""
    t = strip_ws(c)
    u = F.translate(t, "/", "-")
    first, second, third = F.substring_index(u, "-", 1), F.substring_index(F.substring_index(u, "-", 2), "-", -1), F.substring_index(u, "-", -1)
    months = F.expr("map(" + ", ".join(f"'{m}', '{i + 1}'" for i, m in enumerate(MONTH_ABBREVIATIONS)) + ")")
    def ymd_of(y: Column, m: Column, d: Column) -> Column:   # NULL if any part is NULL (unknown month)
        return F.concat(y, F.lit("-"), m, F.lit("-"), d)

    return (F.when(t.rlike(ISO_DATE_SHAPE), F.substring_index(F.translate(t, "t", "T"), "T", 1))
            .when(t.rlike(MDY_SHAPE), ymd_of(third, first, second))
            .when(t.rlike(DMONY_SHAPE), ymd_of(third, F.try_element_at(months, F.lower(second)), first))).try_cast("date")


def normalise_status(c: Column | str, words: dict[str, str] = STATUS_WORDS) -> Column:
    """Case-sensitive vocabulary lookup after trim; anything else is UNKNOWN."""
    vocab = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.coalesce(F.try_element_at(vocab, strip_ws(blank_to_empty(c))), F.lit(UNKNOWN_STATUS))


def normalise_student_id(c: Column | str) -> Column:
    """Keep the digits of the trimmed id; if it has none keep the trimmed id.
    (Prefix-letters-then-digits ids reduce to their digits, the same thing.)"""
    t = strip_ws(blank_to_empty(c))
    return F.coalesce(F.nullif(F.regexp_replace(t, r"[^0-9]", ""), F.lit("")), t)


def one_blank(c: Column | str) -> Column:
    """Trimmed text, every whitespace run one blank (the pattern is compiled once, not for each row as a split does)."""
    return F.regexp_replace(strip_ws(blank_to_empty(c)), WS_RUN, " ")


def split_words(words: Column) -> tuple[Column, Column]:
    """Words parted by one blank: no word -> ('', ''), one -> (w, ''), more -> (all but last, last)."""
    end = F.substring_index(words, " ", -1)
    several = F.contains(words, F.lit(" "))
    first = F.when(several, F.left(words, F.length(words) - F.length(end) - 1)).otherwise(words)
    return first, F.when(several, end).otherwise(F.lit(""))


def split_full_name(c: Column | str) -> tuple[Column, Column]:
    """Whitespace-run split: no word -> ('', ''), one -> (w, ''), more ->
    (all but last joined by one blank, last)."""
    return split_words(one_blank(c))


def normalise_code(c: Column | str) -> Column:
    """Trim, upper-case, blank and hyphen -> underscore (one for one)."""
    return F.translate(F.upper(strip_ws(blank_to_empty(c))), " -", "__")


def clean_optional(c: Column | str) -> Column:
    """NULL, or a missing-word (any case, padded) -> NULL; else the trimmed text."""
    t = strip_ws(_c(c))
    return F.when(F.lower(t).isin(*MISSING_WORDS), F.lit(None).cast("string")).otherwise(t)


def lenient_updated_at(c: Column | str) -> Column:
    """Update time for the watermark filter, or NULL when the row must be
    included regardless (empty, unparseable, or carrying a zone offset).
    Clean-up as in the legacy loader: drop every Z, T -> blank, cut at the
    first dot; then an ISO date with optional hour[:minute[:second]]."""
    s = F.substring_index(F.translate(_c(c), "TZ", " "), ".", 1)
    canon = F.concat(F.substring(s, 1, 10), F.lit(" "), F.substring(s, 12, 8))       # the cast fills in what is missing of the time
    return F.when(s.rlike(UPDATED_AT_SHAPE), canon.try_cast("timestamp_ntz"))


def is_missing_text(c: Column | str) -> Column:
    """NULL or empty — the null test the reconciliation checks use."""
    return _c(c).isNull() | (_c(c) == "")
