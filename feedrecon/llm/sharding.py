"""Sharding by weighted rendezvous hashing (native).

Every key meets every shard: ``u = hash(key, shard)`` in (0, 1) and the score
``-weight / ln(u)``; the highest score wins. The key and the list of shards
alone decide, so a new shard takes rows only into itself, a removed one gives
up only its own, and a shard's share is proportional to its weight.

Slots (a gapless row number inside each shard) come from range partitions and
prefix sums: no task ever holds a whole shard, and only ids, sizes and
checksums are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.llm.util import numbered

#: 13 hexadecimal digits of an MD5 make an integer below 2^52, exact as a double.
HASH_DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A stable number in (0, 1) from the MD5 of the parts joined by ``:``."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, HASH_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** (4 * HASH_DIGITS)))


def scores(key: Column, weights: Sequence[float]) -> Column:
    """Array of ``(score, -shard)`` for shards ``0 .. len(weights) - 1``; a
    weight of zero or less takes nothing. A null key hashes as an empty text."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.array(*[
        F.struct((F.lit(-float(w)) / F.log(uniform(text, F.lit(str(s))))).alias("score"), F.lit(-s).alias("s"))
        for s, w in enumerate(weights) if w > 0])


def winner(scored: Column) -> Column:
    """The shard with the highest score; the smaller number on a tie."""
    return (-F.array_max(scored)["s"]).cast("int")


def assign(df: DataFrame, key: str, weights: Sequence[float], shard_col: str = "shard") -> DataFrame:
    """``df`` with its shard. No shuffle: each row decides alone.

    Null keys all go to the shard of the empty text; repeated rows go where
    their key goes; an empty table stays empty; an existing column of the name
    ``shard_col`` is replaced, all others stay."""
    return df.withColumn(shard_col, winner(scores(F.col(f"`{key}`"), weights)))


def shard_documents(df: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
                    grown_weight: float = 1.0) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard`` (the shard with one more shard of ``grown_weight``).

    Size is the text's UTF-8 bytes plus 1 (null text: 1; its checksum is that
    of an empty text). Slots follow (key, checksum, size), nulls first;
    identical rows take neighbouring slots in any order."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n = len(weights)
    k = F.col(f"`{key}`")
    rows = df.select(k.alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                     F.crc32(body.cast("binary")).alias("text_crc32"))
    rows = (rows.withColumn("_all", scores(F.col("doc_id"), [*weights, grown_weight]))
            .withColumn("shard", winner(F.filter("_all", lambda x: x["s"] > -n)))
            .withColumn("grown_shard", winner(F.col("_all"))).drop("_all"))
    placed = numbered(rows, ["shard", "doc_id", "text_crc32", "size"], group="shard", tag="shard-slots")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("pos").alias("slot"), "grown_shard")


def write_shards(df: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id",
                 rows_per_file: int = 1_000_000) -> None:
    """The documents as Parquet, one folder per shard. Every task writes its own
    file into each shard it has rows for (at most ``rows_per_file`` rows a file), so no
    shard is gathered in one task and nothing is shuffled; a rerun replaces the folders."""
    (assign(df, key, weights).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .partitionBy("shard").parquet(path))
