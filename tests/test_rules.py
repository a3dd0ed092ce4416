"""Rule tables: input -> expected, for every cell rule (SURVEY SCL-*).
Expected values follow the legacy mapper's documented behaviour."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedrecon.functions import rules as R


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    out = df.select("i", fn(F.col("c")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


DATES = [
    ("2021-11-15T10:20:30Z", dt.date(2021, 11, 15)),
    ("2021-11-15T10:20:30", dt.date(2021, 11, 15)),
    ("2021-11-15", dt.date(2021, 11, 15)),
    ("11/15/2021", dt.date(2021, 11, 15)),
    ("1/5/2021", dt.date(2021, 1, 5)),
    ("11-15-2021", dt.date(2021, 11, 15)),
    ("15-Nov-2021", dt.date(2021, 11, 15)),
    ("15-nov-2021", dt.date(2021, 11, 15)),
    ("  2021-01-05\t", dt.date(2021, 1, 5)),
    ("2021-1-5", dt.date(2021, 1, 5)),
    ("2021-01-05T1:2:3", dt.date(2021, 1, 5)),
    ("2021-02-30", None),
    ("2021-01-05T24:00:00", None),
    ("2021-01-05T10:20:30+05:00", None),
    ("0000-01-01", None),
    ("-2021-01-01", None),
    ("12021-01-01", None),
    ("21-01-05", None),
    ("01/05/21", None),
    ("1/5-2021", None),
    ("", None),
    ("null", None),
    ("N/A", None),
    ("UNKNOWN", None),
    ("not-a-date", None),
    (None, None),
]


def test_parse_issue_date(spark):
    got = _apply(spark, [v for v, _ in DATES], R.parse_issue_date)
    assert got == [e for _, e in DATES]


STATUS = [("ACTIVE", "ACTIVE"), ("Active", "ACTIVE"), ("ACT", "ACTIVE"), ("A", "ACTIVE"), ("active", "ACTIVE"),
          ("ISSUED", "ACTIVE"), ("DRAFT", "PENDING"), ("PND", "PENDING"), ("e", "UNKNOWN"), ("issued", "UNKNOWN"),
          ("act", "UNKNOWN"), ("  Expired ", "EXPIRED"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("R", "REVOKED")]


def test_normalise_status(spark):
    assert _apply(spark, [v for v, _ in STATUS], R.normalise_status) == [e for _, e in STATUS]


IDS = [("STU123456", "123456"), ("S-123", "123"), ("12A34", "1234"), ("ABC", "ABC"), ("STU-12-34", "1234"),
       ("  LRN000042 ", "000042"), ("   ", ""), ("", ""), ("uid7", "7")]


def test_normalise_student_id(spark):
    assert _apply(spark, [v for v, _ in IDS], R.normalise_student_id) == [e for _, e in IDS]


NAMES = [("", ("", "")), ("Ada", ("Ada", "")), ("Ada Lovelace", ("Ada", "Lovelace")),
         ("Mary  Ann\tde Vries", ("Mary Ann de", "Vries")), ("  Bo   Li  ", ("Bo", "Li")), (None, ("", ""))]


def test_split_full_name(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(NAMES)], "i int, c string")
    first, last = R.split_full_name(F.col("c"))
    got = [(r.f, r.l) for r in df.select("i", first.alias("f"), last.alias("l")).orderBy("i").collect()]
    assert got == [e for _, e in NAMES]


CODES = [("high school diploma", "HIGH_SCHOOL_DIPLOMA"), ("AP-CREDIT", "AP_CREDIT"), (" ged ", "GED"),
         ("a - b", "A___B"), ("", "")]


def test_normalise_code(spark):
    assert _apply(spark, [v for v, _ in CODES], R.normalise_code) == [e for _, e in CODES]


OPTIONAL = [("n/a", None), ("NULL", None), ("None", None), ("Na", None), (" unknown ", None), ("", None),
            (None, None), ("  Sam ", "Sam"), ("Nate", "Nate")]


def test_clean_optional(spark):
    assert _apply(spark, [v for v, _ in OPTIONAL], R.clean_optional) == [e for _, e in OPTIONAL]


UPDATED = [
    ("2021-11-15T10:20:30", dt.datetime(2021, 11, 15, 10, 20, 30)),
    ("2021-11-15T10:20:30Z", dt.datetime(2021, 11, 15, 10, 20, 30)),
    ("2021-11-15T10:20:30.123Z", dt.datetime(2021, 11, 15, 10, 20, 30)),
    ("2021-11-15", dt.datetime(2021, 11, 15)),
    ("2021-11-15 10", dt.datetime(2021, 11, 15, 10)),
    ("2021-11-15 10:20", dt.datetime(2021, 11, 15, 10, 20)),
    ("2021-11-15T10:20:30+05:00", None),
    ("2021", None),
    ("2021-11", None),
    ("2021-1-5", None),
    ("junk", None),
    ("", None),
    (None, None),
    ("2021-11-15T25:00:00", None),
]


def test_lenient_updated_at(spark):
    assert _apply(spark, [v for v, _ in UPDATED], R.lenient_updated_at) == [e for _, e in UPDATED]


def test_whitespace_set_matches_python():
    assert all(ch.isspace() for ch in R.PY_WHITESPACE)
    assert " \t\n 　" and all(ch in R.PY_WHITESPACE for ch in " \t\n 　")
