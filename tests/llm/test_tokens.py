"""BPE and token files: against the libraries on whole texts, and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from feedrecon.llm import bpe, token_files

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = ["", None, " ", "\n\n  x", "It's  we'll\tbe 1234 ok...  ", "<|endoftext|> plain", "É è\u2003日本語 😀\x1c a\x85b", "a\x00b",
         "x" * 5000, "word " * 30000, " " * 3000 + "y", "ab\n" * 20000, "\u0308 a\u0301 ΣΑΣ İ", "<|ENDOFTEXT|> <|endoftext|>x",
         "straße, à-propos! niño ÿ÷× éÉ íà! œuvre ľ", "a\ue000b \ue000 \ue000c", "QUIZ Kelvin \u212a \u0130 don'T DON't"]


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})


def test_pieces_keep_the_ids(encoding):
    rng = random.Random(0)
    parts = ["word", "'s", " ", "  ", "\n", "1", "é", "!!", "\u00a0", "\x1c", "I'll", "\t"]
    for _ in range(200):
        t = "".join(rng.choice(parts) for _ in range(200))
        cut = list(bpe.pieces(t, 20))
        assert "".join(cut) == t
        assert [i for p in cut for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(t)


def test_encode_and_decode(spark, docs, encoding):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "no id")]
    ranks = bpe.load_ranks(spark, RANKS)
    out = bpe.decode(bpe.encode(docs(rows), ranks, P.PATTERN), ranks, P.PATTERN)
    both = bpe.round_trip(docs(rows), ranks, P.PATTERN)
    assert both.columns == out.columns and both.exceptAll(out).count() == 0 and both.count() == out.count()
    got = out.select("doc_id", "ids", "decoded", *bpe.digests(out), "k0").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        ids, data = encoding.encode_ordinary(t or ""), (t or "").encode()
        r = by[i]
        assert r.ids == ids and bytes(r.decoded) == data and r.n_tokens == len(ids) and r.k0 == "k0!"
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(data).hexdigest()
    empty = docs([])
    assert bpe.decode(bpe.encode(empty, ranks, P.PATTERN), ranks, P.PATTERN).count() == 0


def test_word_lookup_equals_whole_texts():
    with open(WORDS, "rb") as f:
        enc = token_files.WordEncoder(f.read(), cache_words=5)
    assert enc.by_word and enc.width == 2
    texts = [t or "" for t in TEXTS]
    assert enc.encode(texts) == enc._ids(texts) and enc.encode(texts[:3]) == enc._ids(texts[:3])


def test_a_tokenizer_that_keeps_space_gets_whole_texts():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        enc = token_files.WordEncoder(f.read())
    assert not enc.by_word and enc.encode(["a b"]) == enc._ids(["a b"])


def test_token_files_round_trip(spark, docs, tmp_dir):
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 4)] + [(None, "null id"), (5, "again"), (5, "again")]
    manifest = token_files.write_token_files(docs(rows).repartition(4), tmp_dir, token_files.load_tokenizer(spark, WORDS), end_id=1)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda r: r[1])
    plain, want, start = Tokenizer.from_file(WORDS), [], 0
    def place(r):
        h = xxh64_intdigest((r[1] or "").encode(), seed=42)
        return r[0] is not None, r[0] or 0, h - 2 ** 64 if h >= 2 ** 63 else h

    for i, t in sorted(rows, key=place):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    first = manifest.orderBy("part").first()
    flat = token_files.read_flat(f"{first.folder}/{first.file}.bin", np.dtype("<u2"))
    assert isinstance(flat, np.memmap) and len(flat) == first.n_ids


def test_empty_table_has_no_file(spark, docs, tmp_dir):
    manifest = token_files.write_token_files(docs([]), tmp_dir, token_files.load_tokenizer(spark, WORDS))
    assert manifest.count() == 0 and token_files.read_token_files(manifest).count() == 0


def test_object_stores_are_read_by_ranges(tmp_path, monkeypatch):
    """Off a mounted file system a slice reads its own bytes only; Spark's scheme names reach Arrow's file systems."""
    from pyarrow import fs
    np.arange(10_000, dtype="<u2").tofile(tmp_path / "x.bin")
    read = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def size(self):
            return self.f.size()

        def read_at(self, n, at):
            read.append(n)
            return self.f.read_at(n, at)

    class Store:
        def open_input_file(self, path):
            return Counting(fs.LocalFileSystem().open_input_file(path))

    seen = []
    monkeypatch.setattr(token_files, "file_system", lambda uri: seen.append(uri) or (Store(), "/" + uri.split("://")[1]))
    name = f"s3a://{str(tmp_path).lstrip('/')}/x.bin"
    assert token_files.read_flat(name, np.dtype("<u2"), 100, 250).tolist() == list(range(100, 250)) and read == [300]
    assert token_files.read_flat(name, np.dtype("<u2")).tolist() == list(range(10_000))
    assert token_files.read_flat(name, np.dtype("<u2"), 5, 5).tolist() == [] and seen


def test_scheme_names():
    from pyarrow import fs
    assert isinstance(token_files.file_system("file:/tmp/x")[0], fs.LocalFileSystem)
    if hasattr(fs, "S3FileSystem"):
        system, path = token_files.file_system("s3a://bucket/some/key?region=eu-west-1&scheme=http")
        assert isinstance(system, fs.S3FileSystem) and path == "bucket/some/key"


def test_equal_rows_are_dealt(spark, docs, tmp_dir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs([(1, "same words")] * 400), tmp_dir, token_files.load_tokenizer(spark, WORDS))
        assert manifest.count() > 1
        got = token_files.read_token_files(manifest).collect()
        assert sorted(r.start for r in got) == [i * got[0].n_tokens for i in range(400)] and len({r.ids_crc32 for r in got}) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
