"""The corpus pipeline: quality filter, line dedup, near-dedup, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``, and only those, whatever else ``docs`` has (also under the names
the operators use inside). An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.llm import line_dedup, mixing, quality, simhash
from feedrecon.llm.registry import encoded_documents
from feedrecon.llm.util import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; it learns from this stage's documents and the labels.

    Null and empty texts are scored like any other (all statistics zero); null ids teach nothing, but
    their rows are scored; repeated rows are scored alike, so all stay or all go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.keep_good(docs, model).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; ``n_chars`` follows a changed text.

    No row goes: a document of nothing but later copies keeps an empty text. Null texts stay null; null ids
    come first; rows equal in id and text are one document; ties in id are ordered by the text's hash."""
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints stays: that of the smallest id, then text hash.

    Null and empty texts share fingerprint 0 and so are one group; a row without an id stays only where its group
    has no id; of rows equal in id and text one stays."""
    return simhash.keep_one(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Null sources are a source, in the last place; texts without words have size 0 and are taken as often as their rank
    says; rows equal in id, size and checksum share one decision; a source's ties in rank go by id."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with the digests of ids and decoded bytes."""
    return encoded_documents(spark, docs, keep_ids=True)


STAGES = [("quality", filter_quality), ("line_dedup", dedup_lines), ("near_dedup", dedup_near), ("mixing", mix_sources),
          ("encoding", encode)]

#: A trained model, fingerprints and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
