"""The pipeline's stages against brute force, each on its own input."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from feedrecon.llm import bpe, mixing, simhash
from feedrecon.llm.util import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    frames = [docs]
    for name, stage in C.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF), name))
    start, good, lines, near, mixed, encoded = [f.collect() for f in frames]
    assert [n for n, _ in C.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "encoding"]
    for f in frames[:-1]:
        assert f.columns == C.COLUMNS

    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in good}
    assert kept < {r.doc_id for r in start}
    assert all(labels[i] == 0 for i in labels if i not in kept)                  # clean documents stay
    assert sum(labels[i] == 0 for i in labels if i in kept) <= 1

    assert [r.doc_id for r in lines if len(r.text) > 0] and {r.doc_id for r in lines} == kept
    seen = set()
    for r in sorted(lines, key=lambda r: r.doc_id):
        big = [x for x in r.text.split("\n") if len(x.split()) >= 50]
        assert not seen & set(big)                                               # no long line twice
        seen |= set(big)
        assert r.n_chars == len(r.text)

    fps = {r.doc_id: simhash.fingerprint(r.text) for r in lines}
    ids = sorted(fps)
    comp = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and bin(fps[i] ^ fps[j]).count("1") <= 3 and comp[i] != comp[j]:
                low, high = sorted((comp[i], comp[j]))
                comp = {k: low if v == high else v for k, v in comp.items()}
    assert {r.doc_id for r in near} == set(comp.values())

    taken = {r.doc_id: r.copies for r in mixing.mix(frames[3]).collect()}
    counts = {}
    for r in mixed:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in taken.items() if n}

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        enc = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
    text = {r.doc_id: r.text for r in mixed}
    assert len(encoded) == len(mixed)
    for r in encoded:
        assert r.ids == enc.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_and_registry(spark):
    import __spark_entry__ as E
    out = E.queries()["pipeline"](spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} == set(out.columns) and out.count() > 0
    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))


def _odd(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["row", "th", "d", "spans", "size", "rank", "fp", "ids", "first", "place", "copies", "removed_lines", "score"]
    return df.select(*[F.lit(f"{c}!").alias(c) for c in clash], "*")


LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + ".\n"
ROWS = ([(i, f"A good plain sentence number {i} with some more words in it, and an end.\nAnd line {i * 7}.", "en", f"s{i % 3}", 9) for i in range(30)]
        + [(30, None, None, None, None), (31, "", "en", None, 0), (None, "a text without an id", "en", "s1", 20), (None, None, None, None, None),
           (3, "another text of the same id", "en", "s0", 27), (3, "another text of the same id", "en", "s0", 27),
           (40, LONG, "en", "s0", len(LONG)), (41, LONG, "en", "s1", len(LONG)), (42, " \n\t ", "", "", 4)])


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    out = stage(spark, stored(_odd(spark, ROWS), f"odd-{name}"), SF)
    rows = out.collect()
    key = lambda r: (r.doc_id, r.text) if name != "encoding" else r.doc_id
    given = Counter((r[0], r[1]) for r in ROWS)
    if name != "encoding":
        assert out.columns == C.COLUMNS
    if name == "quality":
        assert all(given[key(r)] for r in rows) and all(n in (0, given[k]) for k, n in Counter(map(key, rows)).items())
    if name == "line_dedup":
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
        assert {r.doc_id: r.text for r in rows}[41] == "" and {r.doc_id: r.text for r in rows}[30] is None
        assert [r.n_chars for r in rows if r.doc_id == 41] == [0]
    if name == "near_dedup":
        assert max(Counter(map(key, rows)).values()) == 1 and (40, LONG) in set(map(key, rows)) and (41, LONG) not in set(map(key, rows))
        assert [r.doc_id for r in rows if not (r.text or "").split()] == [30]             # one of the texts without a word
    if name == "mixing":
        assert all(given[key(r)] for r in rows) and all(n <= 3 * given[k] for k, n in Counter(map(key, rows)).items())
    if name == "encoding":
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
        assert all(r.decoded_sha256 == hashlib.sha256(b"").hexdigest() and r.n_tokens == 0 for r in rows if r.doc_id in (30, 31))


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_take_an_empty_table(spark, name, stage):
    assert stage(spark, stored(_odd(spark, []), f"none-{name}"), SF).count() == 0
