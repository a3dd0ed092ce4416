"""Credential feeds derived from the driver tables.

The driver tables are not credential feeds, so the feeds are derived from
``orders ⋈ customer``: one legacy record per order (plus an injected second
copy for some), its layout chosen by the order key, cells written in that
layout's conventions, and irregular cells injected by modulus so every check
has something to find. The result is in *slot form*: the cells sit in
canonical slot columns (``raw_student_id`` …) next to the layout version, i.e.
the union of all layouts' feeds after binding each layout's columns to slots.

The same derivation is written as SQL text in ``plans/oracle.py`` so that DuckDB
can check every query end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.layouts import LAYOUTS, SLOTS, Layout
from feedrecon.operators.checks import ALLOWED_CREDENTIAL_TYPES
from feedrecon.sources.tables import table

def _pick(index: Column, values: tuple[str, ...], base: int = 0) -> Column:
    """values[index - base] of a literal array (NULL outside it): no branch a value, so that the generated method stays small."""
    return F.get(F.array(*[F.lit(v) for v in values]), (index - base).cast("int"))


def feed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order joined to its customer, with the per-record facts the
    layouts render. The join is left to Catalyst/AQE: customer is broadcast
    only when its measured size is under the broadcast threshold, otherwise it
    is a sort-merge join on the customer key. The narrow order rows are dealt out first, so that rendering the
    cells has as many tasks as a shuffle, whatever files and row groups the orders come in."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    orders = orders.repartition("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    k = F.col("o_orderkey")
    si = (F.when(k % 31 == 0, 3).when(F.col("o_orderstatus") == "O", 1)
          .when(F.col("o_orderstatus") == "F", 2).otherwise(4))
    typ_idx = (F.col("o_custkey") + F.when(k % 53 == 2, 1).otherwise(0)) % 10
    return j.select(
        k.alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("c_mktsegment").alias("seg"),
        F.substring("c_name", 10, 1 << 30).alias("sur"),
        F.col("c_nationkey").alias("nk"),
        (F.lit(1) + k % 8).cast("int").alias("v"),
        si.alias("si"),
        F.add_months(F.to_date("o_orderdate"), 240).alias("d"),
        _pick(typ_idx, ALLOWED_CREDENTIAL_TYPES).alias("typ"),
    )


def credential_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All legacy records of all layouts in slot form:
    ``k, copy_no, ver, raw_*`` (every raw cell is text or NULL)."""
    b = feed_base(spark, sf_dir)
    k, v, d, si = F.col("k"), F.col("v"), F.col("d"), F.col("si")
    iso = d.cast("string")
    upd = F.date_add(d, (k % 91).cast("int")).cast("string")
    mm = F.lpad(F.month(d).cast("string"), 2, "0")
    dd = F.lpad(F.dayofmonth(d).cast("string"), 2, "0")
    yyyy = F.year(d).cast("string")
    st = _pick(si, ("ACTIVE", "EXPIRED", "REVOKED", "PENDING"), base=1)
    title = F.concat(F.substring(st, 1, 1), F.lower(F.substring(st, 2, 1 << 30)))
    full_name_v = v.isin(1, 5, 8)

    # A second copy of some records, emitted by exploding a one- or two-element
    # array: one pass over the join, no second scan.
    copies = b.withColumn("copy_no", F.explode(
        F.when(k % 173 == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))

    id_prefix = _pick(v, ("STU", "S", "stu", "LRN", "STU", "", "SN", "UID"), base=1)
    full_id = F.concat(id_prefix, (F.lit(100000) + F.col("ck")).cast("string"))
    school = F.concat(F.lit("DIST"), F.lpad(F.col("nk").cast("string"), 3, "0"), F.lit("-SCH"),
                      F.lpad(F.when(k % 97 == 1, 999).otherwise(F.col("ck") % 30).cast("string"), 3, "0"))
    typ = F.col("typ")
    raw_type = (F.when(v.isin(2, 7), F.lower(F.replace(typ, F.lit("_"), F.lit(" "))))
                .when(v == 4, F.replace(typ, F.lit("_"), F.lit("-")))
                .otherwise(typ))
    issue = (F.when(v == 1, F.concat(iso, F.lit("T00:00:00")))
             .when(v == 2, F.concat_ws("/", mm, dd, yyyy))
             .when(v == 5, F.date_format(d, "dd-MMM-yyyy"))
             .when(v == 6, F.concat(iso, F.lit("T00:00:00Z")))
             .when(v == 7, F.concat_ws("-", mm, dd, yyyy))
             .otherwise(iso))
    status = (F.when(v == 3, _pick(si, LAYOUTS["v3"].status_vocab, base=1))
              .when(v == 4, _pick(si, LAYOUTS["v4"].status_vocab, base=1))
              .when(v.isin(2, 7), title)
              .when(v == 6, F.lower(st))
              .when(v == 8, F.when(si == 1, F.lit("ISSUED")).when(si == 4, F.lit("DRAFT")).otherwise(st))
              .otherwise(st))
    preferred = (F.when(v.isin(3, 5, 6), F.lit(None).cast("string"))
                 .when(k % 5 < 2, F.col("seg"))
                 .when(v.isin(2, 8), F.lit("N/A"))
                 .when(v == 4, F.lit("UNKNOWN"))
                 .otherwise(F.lit("")))
    return copies.select(
        k, "copy_no",
        F.concat(F.lit("v"), v.cast("string")).alias("ver"),
        F.when(k % 307 == 5, F.lit("")).when(k % 311 == 12, F.concat(id_prefix, F.lit("12")))
         .when(k % 19 == 3, F.concat(F.lit("  "), full_id, F.lit(" "))).otherwise(full_id).alias("raw_student_id"),
        F.when(full_name_v, F.when(k % 263 == 7, F.col("seg"))
               .when(k % 29 == 4, F.concat_ws(" ", F.col("seg"), F.lit("Van"), F.col("sur")))
               .otherwise(F.concat_ws(" ", F.col("seg"), F.col("sur")))).alias("raw_full_name"),
        F.when(~full_name_v, F.col("seg")).alias("raw_first_name"),
        F.when(~full_name_v, F.col("sur")).alias("raw_last_name"),
        F.when(k % 401 == 3, F.lit("")).otherwise(school).alias("raw_school_id"),
        F.when(k % 223 == 9, F.lit("bogus type")).otherwise(raw_type).alias("raw_type"),
        F.when(k % 211 == 7, F.lit("not-a-date")).otherwise(issue).alias("raw_issue_date"),
        F.when(k % 101 == 9, F.lit("BOGUS")).otherwise(status).alias("raw_status"),
        preferred.alias("raw_preferred"),
        F.when(k % 131 == 6, F.lit("")).when(k % 139 == 10, F.lit("1999-12-31T00:00:00")).otherwise(F.concat(upd, F.lit("T00:00:00"))).alias("raw_updated_at"),
    )


def feed_file_name(ver: Column) -> Column:
    """File name a layout's feed is delivered under."""
    return F.concat(F.lit("credentials_"), ver, F.lit(".csv"))


def layout_feed(slot_df: DataFrame, lay: Layout) -> DataFrame:
    """The records of one layout as its own file would hold them: the layout's
    column names, in its order, every cell text."""
    by_source = {lay.source_for(s): s for s in SLOTS if lay.source_for(s)}
    return (slot_df.where(F.col("ver") == lay.version)
            .select(*[F.col(by_source[c]).alias(c) for c in lay.columns]))


def header_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed header per order: ``feed`` (the order key) and ``header``
    (array of column names) — the layout's columns, then altered by modulus:
    %37 drop the first fingerprint column, %41 add the next layout's columns,
    %3 add an extra column, %43 upper-case every name."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    lays = list(LAYOUTS.values())
    cols = _pick_array("o_orderkey % 8", [list(l.columns) for l in lays])   # layout index 0..7
    first_fp = _pick_array("o_orderkey % 8", [[l.fingerprint[0]] for l in lays])
    nxt = _pick_array("(o_orderkey + 1) % 8", [list(l.columns) for l in lays])
    h = F.when(k % 37 == 0, F.array_except(cols, first_fp)).otherwise(cols)
    h = F.when(k % 41 == 0, F.concat(h, nxt)).otherwise(h)
    h = F.when(k % 3 == 0, F.concat(h, F.array(F.lit("extra_col")))).otherwise(h)
    h = F.when(k % 43 == 0, F.transform(h, F.upper)).otherwise(h)
    return orders.select(k.alias("feed"), h.alias("header"))


def _pick_array(index_sql: str, arrays: list[list[str]]) -> Column:
    """arrays[index] as one SQL CASE over array literals."""
    return F.expr(f"CASE {index_sql} " + " ".join(
        f"WHEN {i} THEN array(" + ", ".join(f"'{x}'" for x in arr) + ")" for i, arr in enumerate(arrays)) + " END")
