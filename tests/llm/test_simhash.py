"""SimHash: fingerprints and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from feedrecon.llm import simhash as S


def plain_fingerprint(text, shingle=3):
    words = [w for w in (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()]
    grams = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    hs = [xxh64_intdigest(b" ".join(g), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, ids, bits):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least.get(root(i)) for i in range(len(fps))]


TEXTS = ["", None, "one", "One  TWO", "one two three", "ONE two three", "É é x\x1cy z", "a b c " * 500, " \t\n", "a\x0bb\x0cc\rd e"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("words", [65_536, 65_537, 65_538, 65_539, 131_073, 131_075, 200_000])
def test_fingerprint_over_several_chunks(words):
    """No shingle is lost or counted twice where a chunk of hashes ends."""
    rng = random.Random(words)
    vocab = [f"w{i}" for i in range(50)]
    text = [rng.choice(vocab) for _ in range(words)]
    hs = np.array([xxh64_intdigest(" ".join(text[i:i + 3]).encode(), seed=42) for i in range(words - 2)], "<u8")
    counts = np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    assert S.fingerprint(" ".join(text)) == sum(1 << b for b in range(64) if 2 * counts[b] > len(hs))


def test_every_chunk_size_gives_the_same(monkeypatch):
    """Bits that one shingle decides: small chunks against the plain version."""
    rng = random.Random(9)
    for k in (1, 2, 3, 5):
        monkeypatch.setattr(S, "_CHUNK", k)
        for n in range(1, 24):
            text = " ".join(rng.choice("abcdefg") for _ in range(n))
            assert S.fingerprint(text) == plain_fingerprint(text)


def test_components_match_brute_force(docs):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, base = [], [rng.choice(vocab) for _ in range(300)]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((100 - i, " ".join(words)))
    rows += [(200 + i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(300 + i, t) for i, t in enumerate(TEXTS)] + [(None, None), (None, base[0]), (200, rows[60][1])]
    got = S.near_duplicates(docs(rows)).collect()
    fps = {r: plain_fingerprint(r[1]) for r in rows}
    want = components([fps[r] for r in rows], [r[0] for r in rows], 3)
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or 0)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=order) == sorted(
        [(r[0], f"{fps[r]:016x}", c) for r, c in zip(rows, want, strict=True)], key=order)


def test_large_groups_are_cut_without_loss(spark):
    """Fingerprints crowded in one corner: groups above the bound meet chunk by chunk."""
    rng = np.random.default_rng(1)
    fps = sorted({int(x) for x in rng.integers(0, 1 << 14, 900)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from feedrecon.llm.components import connected_components
    found = connected_components(S.near_links(df, max_bits=1, group=64), "a", "b").collect()
    got = {r.node: r.component for r in found}
    want = components(fps, fps, 1)
    assert [got.get(f, f) for f in fps] == want
    assert {f for f in fps if f in got} == {f for f, c in zip(fps, want, strict=True) if want.count(c) > 1}


def test_pivot_table_discards_only_far_pairs():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 60, 150, dtype=np.uint64))
    table = np.stack([np.bitwise_count(fps ^ np.uint64(p % 2 ** 64)) for p in S.pivots()], 1).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    a, b = S.links_in_groups(np.zeros(300, int), fps[order], table[order], 3)
    got = {frozenset((int(fps[order][i]), int(fps[order][j]))) for i, j in zip(a, b, strict=True)}
    want = {frozenset((int(x), int(y))) for i, x in enumerate(fps) for y in fps[:i] if bin(int(x ^ y)).count("1") <= 3}
    assert got == want and len(got) >= 150


def test_keep_one(docs):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "a quite different text of words"), (8, None), (7, ""),
            (None, "x y z w v"), (None, "x y z w v")]
    got = S.keep_one(docs(rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.th) for r in got.collect()) == [
        (-1, "x y z w v", "th!"), (3, "a b c d", "th!"), (7, "", "th!"), (9, "a quite different text of words", "th!")]
    assert got.columns == docs(rows).columns


def test_empty_table(docs):
    assert S.near_duplicates(docs([])).count() == 0
    assert S.keep_one(docs([])).count() == 0


def test_block_masks_cover_every_difference():
    masks = S.block_masks(6, 3)
    rng = random.Random(3)
    for _ in range(300):
        diff = sum({1 << rng.randrange(64) for _ in range(3)})
        assert any((m % 2 ** 64) & diff == 0 for m in masks)
    assert len(masks) == 20


def test_hash_is_spark_xxhash64(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert got % 2 ** 64 == xxh64_intdigest(b"one two three", seed=42)
