"""J1 — recognise a feed's layout from its header.

A layout matches when its fingerprint is a subset of the header (case
sensitive, order free, extra columns allowed); among several matches the
larger fingerprint wins, ties go to registry order; no match is UNKNOWN.

``classify_headers`` works on one row per feed (``feed, header`` array): one
``array_contains`` per fingerprint column per row, no shuffle, no join.
The per-row decision is one SQL CASE expression. ``classify_long`` does
the same on long-form input (``feed, column``) as a relational division
against the broadcast fingerprint table (54 fixed rows): one bit mask per
layout is OR-ed per feed in a single hash aggregate (one exchange), so
duplicate header names are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.layouts import LAYOUTS, Layout, detection_order, fingerprints_df

UNKNOWN = "UNKNOWN"


def _has_all_sql(header: str, cols) -> str:
    return "(" + " AND ".join(f"coalesce(array_contains({header}, '{c}'), false)" for c in cols) + ")"


def classify_sql(header: str = "header", layouts: dict[str, Layout] = LAYOUTS) -> tuple[str, str]:
    """SQL for (winning layout or UNKNOWN, number of matching layouts) of a
    header array column: every fingerprint column must be in the header
    (``array_contains``); the CASE lists layouts larger-first, registry order
    among equals, so its first hit is the winner."""
    flags = {v: _has_all_sql(header, l.fingerprint) for v, l in layouts.items()}
    version = ("CASE " + " ".join(f"WHEN {flags[l.version]} THEN '{l.version}'" for l in detection_order(layouts))
               + f" ELSE '{UNKNOWN}' END")
    matches = "CAST(" + " + ".join(f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in flags.values()) + " AS BIGINT)"
    return version, matches


def classify_headers(headers: DataFrame, header_col: str = "header", layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """``feed, header`` → ``feed, header, version, matches`` (``matches`` = how
    many layouts fit; ``version`` = winner or UNKNOWN). One projection."""
    version, matches = classify_sql(f"`{header_col}`", layouts)
    return headers.select("*", F.expr(version).alias("version"), F.expr(matches).alias("matches"))


def classify_long(long_df: DataFrame, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """``feed, column`` → ``feed, version, matches`` (relational division).

    One broadcast join to the fingerprint rows (a column may sit in several
    layouts) and **one** aggregation per feed holding a bit mask per layout
    (``bit_or`` combines map-side); a layout matches when its mask is full.
    Columns in no fingerprint keep their feed in the result (left join)."""
    fps = F.broadcast(fingerprints_df(long_df.sparkSession, layouts))
    hits = long_df.join(fps, "column", "left")
    masks = hits.groupBy("feed").agg(*[
        F.expr(f"coalesce(bit_or(CASE WHEN version = '{v}' THEN flag END), 0) AS m_{v}") for v in layouts])
    full = {v: (1 << len(l.fingerprint)) - 1 for v, l in layouts.items()}
    flags = {v: f"(m_{v} = {full[v]})" for v in layouts}
    version = ("CASE " + " ".join(f"WHEN {flags[l.version]} THEN '{l.version}'" for l in detection_order(layouts))
               + f" ELSE '{UNKNOWN}' END AS version")
    matches = "CAST(" + " + ".join(f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in flags.values()) + " AS BIGINT) AS matches"
    return masks.selectExpr("feed", version, matches)


def unknown_feeds(classified: DataFrame, header_col: str = "header", layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """CLS-3: feeds no layout fits, with their columns sorted and the legacy
    error text (sorted columns and every fingerprint)."""
    sorted_cols = F.array_join(F.array_sort(F.col(header_col)), ",")
    return (classified.where(F.col("version") == UNKNOWN)
            .select("feed", sorted_cols.alias("sorted_columns"), unknown_message(sorted_cols, layouts).alias("message")))


def unknown_message(sorted_columns: Column, layouts: dict[str, Layout] = LAYOUTS) -> Column:
    """The text a failed detection reports (sorted columns + every fingerprint)."""
    fps = "\n".join(f"  {v}: {sorted(l.fingerprint)}" for v, l in layouts.items())
    cols = F.concat(F.lit("["), F.array_join(F.transform(F.split(sorted_columns, ","),
                                                          lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    return F.concat(F.lit(f"Unknown schema version. Column set does not match any of the {len(layouts)} known fingerprints.\n"
                          "Columns found: "), cols, F.lit("\nKnown fingerprints:\n" + fps))
