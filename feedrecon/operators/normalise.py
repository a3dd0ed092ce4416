"""J2 — map legacy feeds onto the canonical staging schema.

Input is *slot form* (``ver`` + ``raw_*`` text cells, see sources.fixtures);
``bind_layout`` produces it from a DataFrame that carries a layout's own column
names (a CSV file read as text). The mapping is one projection: no shuffle, no
Python, every rule a built-in column expression. Rows are tagged with the rules
they break and split into accepted and quarantined rows from the same plan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.functions import rules as R
from feedrecon.layouts import LAYOUTS, SLOTS, Layout

CANONICAL = ("student_id", "first_name", "last_name", "preferred_name", "school_id", "credential_type",
             "issue_date", "status", "source_schema_version", "source_student_id")
STAGING = CANONICAL + ("staged_at",)

# Reasons in the order the legacy mapper tests them; the first is reported.
REASONS = ("missing_student_id", "missing_school_id", "unparseable_issue_date")


def bind_layout(df: DataFrame, lay: Layout, *keep: str) -> DataFrame:
    """Rename a layout's columns onto the canonical slots.

    A column the file lacks reads as ``""`` (a CSV cell Spark read as NULL is
    ``""`` too); slots the layout does not have are NULL."""
    present = set(df.columns)

    def cell(slot: str) -> Column:
        src = lay.source_for(slot)
        if src is None:
            return F.lit(None).cast("string").alias(slot)
        if src not in present:
            return F.lit("").alias(slot)
        return R.blank_to_empty(F.col(f"`{src}`")).alias(slot)

    return df.select(*keep, F.lit(lay.version).alias("ver"), *[cell(s) for s in SLOTS])


def tag(slot_df: DataFrame, *keep: str, run_ts: _dt.datetime | None = None,
        layouts: dict[str, Layout] = LAYOUTS, status_words: dict[str, str] = R.STATUS_WORDS) -> DataFrame:
    """Canonical columns plus ``accepted`` and ``reasons`` (array of broken
    rules, empty when the row is accepted). ``keep`` names pass-through columns (lineage, feed).
    ``layouts`` says which versions carry one full name and which a preferred name."""
    ver = F.col("ver")
    # what several columns need is a column of its own first: worked out once a row, and the generated methods stay
    # under the size up to which the JVM compiles them
    slot_df = slot_df.withColumns({"words ": R.one_blank("raw_full_name"), "issue ": R.parse_issue_date(F.col("raw_issue_date"))})
    full_first, full_last = R.split_words(F.col("words "))
    is_full = ver.isin(*[v for v, lay in layouts.items() if lay.has_full_name])
    has_preferred = ver.isin(*[v for v, lay in layouts.items() if lay.has_preferred])
    raw_id = F.col("raw_student_id")
    raw_school = F.col("raw_school_id")
    issue = F.col("issue ")
    # acceptance is three cheap tests; the reasons array is built only for
    # rejected rows (concat_ws skips NULLs and stays in generated code)
    ok = ~R.is_missing_text(raw_id) & ~R.is_missing_text(raw_school) & issue.isNotNull()
    reason_txt = F.concat_ws(",",
                             F.when(R.is_missing_text(raw_id), F.lit(REASONS[0])),
                             F.when(R.is_missing_text(raw_school), F.lit(REASONS[1])),
                             F.when(issue.isNull(), F.lit(REASONS[2])))
    reasons = F.when(ok, F.array().cast("array<string>")).otherwise(F.split(reason_txt, ","))
    exprs = {
        "student_id": R.normalise_student_id(raw_id),
        "first_name": F.when(is_full, full_first).otherwise(R.strip_ws(R.blank_to_empty("raw_first_name"))),
        "last_name": F.when(is_full, full_last).otherwise(R.strip_ws(R.blank_to_empty("raw_last_name"))),
        "preferred_name": F.when(has_preferred, R.clean_optional(R.blank_to_empty("raw_preferred")))
                           .otherwise(F.lit(None).cast("string")),
        "school_id": R.strip_ws(R.blank_to_empty(raw_school)),
        "credential_type": R.normalise_code("raw_type"),
        "issue_date": issue,
        "status": R.normalise_status("raw_status", status_words),
        "source_schema_version": ver,
        "source_student_id": R.strip_ws(R.blank_to_empty(raw_id)),
    }
    if run_ts is not None:
        exprs["staged_at"] = R.ntz(run_ts)
    exprs["accepted"] = ok
    exprs["reasons"] = reasons
    return slot_df.select(*keep, *[e.alias(name) for name, e in exprs.items()])


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("accepted")).drop("accepted", "reasons")


def quarantined(tagged: DataFrame) -> DataFrame:
    """Rejected rows with every broken rule and the first one (the legacy reason)."""
    return tagged.where(~F.col("accepted")).drop("accepted").withColumn("reason", F.element_at("reasons", 1))


def normalise(slot_df: DataFrame, *keep: str, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Accepted canonical rows of a slot-form feed."""
    return accepted(tag(slot_df, *keep, run_ts=run_ts))


def quarantine_by_reason(tagged: DataFrame) -> DataFrame:
    """Rejected rows per version and first reason (partial aggregation before
    the shuffle: the key space is 8 versions x 3 reasons)."""
    return (quarantined(tagged).groupBy("source_schema_version", "reason")
            .agg(F.count(F.lit(1)).alias("rows")))
