"""The registered queries of this subpackage: thin ``opN_*`` queries with
production parameters over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.llm import bpe, conversation, divergence, hnsw, language, line_dedup, mixing, quality, sharding, simhash, token_files, topk, url_filter
from feedrecon.llm.oracle import ORACLE
from feedrecon.llm.util import table
from feedrecon.session import new_work_dir

SHARDS = 8


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"),
                                  url_filter.rules_table(spark, url_filter.RULES))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def encoded_documents(spark: SparkSession, docs: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Ids, decoded again, as digests per document; with the ids themselves if asked for."""
    import public_tokenizers
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return rows.select("doc_id", *bpe.digests(rows), *(["ids"] if keep_ids else []))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(spark, table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("v"))
    return topk.top_k(vectors.where("id % 20 = 0"), vectors)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    tokenizer = token_files.load_tokenizer(spark, public_tokenizers.path("word_bpe_49k.json"))
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"),
                                             new_work_dir(spark, "token-files"), tokenizer, end_id=1)
    return token_files.read_token_files(manifest)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), [1.0] * SHARDS)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation.audit(turns, conversation.damage(turns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language.predict(docs, language.fit(docs))


REGISTRY = {f.__name__: f for f in (op1_line_dedup, op2_simhash, op3_embedding_dedup, op4_url_filter, op5_source_mixing, op6_bpe, op7_exact_topk, op8_token_files, op9_quality,
                                    op10_sharding, op11_conversation_repair, op12_source_divergence, op13_language_id, pipeline)}
ORACLE = {k: v for k, v in ORACLE.items() if k in REGISTRY}
