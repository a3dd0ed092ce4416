"""Rendezvous hashing: the key law, weights, slots."""

import hashlib
import math
import zlib

from pyspark.sql import functions as F

from feedrecon.llm import sharding as S


def winner(key, weights):
    def u(s):
        return (int(hashlib.md5(f"{'' if key is None else key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    return max((s for s, w in enumerate(weights) if w > 0), key=lambda s: (-weights[s] / math.log(u(s)), -s))


ROWS = [(i, f"text {i % 40}" if i % 9 else None) for i in range(700)] + [(3, "text 3"), (3, "text 3"), (None, "é"), (None, None), (701, "ab" * 50000)]


def test_shard_documents(docs):
    got = S.shard_documents(docs(ROWS).repartition(5), [1.0] * 8).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), winner(i, [1] * 8), winner(i, [1] * 9)) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.law == "key" and r.grown_shard in (r.shard, 8) for r in got)


def test_slots_follow_the_key(docs):
    got = sorted(S.shard_documents(docs(ROWS).repartition(3), [1.0] * 4).collect(), key=lambda r: (r.shard, r.slot))
    for a, b in zip(got, got[1:], strict=False):
        if a.shard == b.shard:
            assert (a.doc_id is not None, a.doc_id or 0, a.text_crc32) <= (b.doc_id is not None, b.doc_id or 0, b.text_crc32)


def test_weights(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    n = {r["shard"]: r["count"] for r in S.assign(df, "doc_id", [1.0, 0.0, 3.0]).groupBy("shard").count().collect()}
    assert set(n) == {0, 2} and abs(n[2] / 20000 - 0.75) < 0.02


def test_existing_column_is_replaced_and_empty(docs):
    out = S.assign(docs(ROWS[:5]), "doc_id", [1.0, 1.0])
    assert out.columns == docs(ROWS[:5]).columns and dict(out.dtypes)["shard"] == "int"
    assert S.shard_documents(docs([]), [1.0] * 8).count() == 0


def test_write_shards(docs, tmp_dir, spark):
    S.write_shards(docs(ROWS).drop("shard"), tmp_dir, [1.0] * 3)
    back = spark.read.parquet(tmp_dir)
    assert back.count() == len(ROWS)
    assert back.where(F.col("shard") != S.winner(S.scores(F.col("doc_id"), [1.0] * 3))).count() == 0
