"""Language ID: a plain Viterbi, held-out accuracy, spans, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedrecon.llm import language as L
from feedrecon.llm.util import table

SF = "/root/testdata/sf0.01"
EN, DE = "the house is where the children have their home and this is what they think of it ", "das Haus ist dort wo die Kinder ihre Heimat haben und sie denken nicht weiter darüber nach "
RU, EL = "дом находится там где дети живут и думают о нём ", "το σπίτι είναι εκεί που τα παιδιά μένουν και σκέφτονται "


def plain_viterbi(e, switch):
    v, back = np.zeros(e.shape[1]), []
    for row in e:
        top = v.max() - switch
        back.append([j if v[j] >= top else int(v.argmax()) for j in range(len(v))])
        v = np.maximum(v, top) + row
    path, state = [], int(v.argmax())
    for row in reversed(back):
        path.append(state)
        state = row[state]
    return path[::-1]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t * 5, g) for g, t in (("en", EN), ("de", DE), ("ru", RU), ("el", EL)) for i in range(30)]
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_blocks_give_the_plain_path():
    rng = np.random.default_rng(0)
    for block in (1, 2, 3, 7, 512):
        count = np.array([0, 1, 5, 0, 23, 2, 64, 3, 0])
        e = -rng.integers(0, 9, (count.sum(), 4)).astype(np.float32)
        e[rng.random(e.shape) < 0.05] = -np.inf
        e[np.isneginf(e).all(axis=1)] = 0
        got = L.viterbi(e, count, switch=6.0, block=block)
        at = np.concatenate(([0], np.cumsum(count)))
        want = [s for lo, hi in zip(at, at[1:], strict=False) for s in plain_viterbi(e[lo:hi].astype(float), 6.0)]
        assert got.tolist() == want


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = L.predict(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got) and len(got) == docs.count()
    assert all(0 <= r.score <= 1 for r in got)
    test = [r.lang_pred == r.lang for r in got if r.held_out]
    assert len(test) > 200 and np.mean(test) >= 0.98


def test_held_out_documents_do_not_matter(spark):
    docs = table(spark, SF, "documents", "doc_id", "text", "lang")
    turned = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a, b = L.fit(docs, max_documents=50), L.fit(turned, max_documents=50)
    assert a.langs == b.langs and np.array_equal(a.table, b.table)


def test_spans_of_mixed_text(model):
    text = "1. " + EN * 3 + "-- " + DE * 3 + RU + EN
    (spans, lang, score), = L.label(model, [text])
    assert [s["lang"] for s in spans] == ["en", "de", "ru", "en"] and lang == "en" and 0.4 < score < 0.8
    assert [text[s["start"]:s["end"]].split()[0] for s in spans] == ["the", "das", "дом", "the"]
    assert text[spans[2]["start"]:spans[2]["end"]] == RU.strip()


def test_script_narrows_candidates(model):
    e = model.emissions(L.words_of(["дом house 漢字"]))
    assert sorted(np.flatnonzero(~np.isneginf(e[0]))) == [model.langs.index("ru")]
    assert sorted(model.langs[i] for i in np.flatnonzero(~np.isneginf(e[1]))) == ["de", "en"]
    assert (e[2] == 0).all()                       # a script no language uses: all stay


def test_chunks_and_blocks_do_not_matter(model, monkeypatch):
    texts = [EN * 40, "", None, DE + RU * 30, "x", EL * 100 + EN, "123 !"] * 3
    want = list(L.label(model, texts))
    monkeypatch.setattr(L, "CELLS", 50)
    assert list(L.label(model, texts)) == want


def test_edge_cases(spark, model, docs):
    rows = [(1, None), (2, ""), (3, "12 -- !"), (4, "Z"), (None, EN), (5, DE), (5, DE), (6, (EN + DE) * 20_000), (7, "퟿漢\U0001F600é")]
    got = L.predict(docs(rows), model)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by = {(r.doc_id, k): r for k, r in enumerate(got.collect())}
    assert len(by) == len(rows)
    for (key, _), r in by.items():
        assert (r.lang_pred == "und" and r.score == 0) == (key in (1, 2, 3))
        assert r.lang_pred in [*model.langs, "und"] and 0 <= r.score <= 1
    assert sorted(r.lang_pred for (k, _), r in by.items() if k in (None, 5)) == ["de", "de", "en"]


def test_empty_tables_and_nothing_learned(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = L.fit(empty)
    assert none.langs == [] and L.predict(empty, none).collect() == []
    some = spark.createDataFrame([(1, EN, None), (2, "123", "xx"), (None, EN, "en")], "doc_id long, text string, lang string")
    assert L.fit(some).langs == []
    assert [(r.lang_pred, r.score) for r in L.predict(some, none).collect()] == [("und", 0.0)] * 3
