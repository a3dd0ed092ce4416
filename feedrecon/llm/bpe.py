"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver, checked against ``MAX_RANK_BYTES`` and
broadcast, so executors need no copy of it. Texts arrive in Arrow batches and
are encoded whole, one at a time. A long text is cut before a single space
between two characters that are not white space: no match of the split pattern
can cross such a place, as a space only ever starts a match, so the pieces'
ids joined are the text's ids. Decoding joins the tokens' raw bytes.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrecon.llm.util import release_memory

MAX_RANK_BYTES = 64 << 20
#: Texts longer than this many characters are encoded in pieces of about this size.
PIECE = 1 << 16
#: Token ids of one output batch, about.
BATCH_IDS = 1 << 18
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_LOADED: dict = {}


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a tiktoken rank file on the driver, as a broadcast of proven size."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"rank file over {MAX_RANK_BYTES} bytes: {path}")
    return spark.sparkContext.broadcast(data)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def encoder(data: bytes, pattern: str):
    """The tiktoken encoding of a rank file, once per worker process."""
    import tiktoken
    key = (hash(data), pattern)
    if key not in _LOADED:
        ranks = parse_ranks(data)
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        _LOADED[key] = (tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), by_id)
    return _LOADED[key]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in pieces of at least ``size`` characters, cut at safe places only (none: one piece)."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding, text: str) -> list[int]:
    """Ids of a whole text; strings that look like special tokens are ordinary text."""
    if len(text) <= PIECE:
        return encoding.encode_ordinary(text)
    return [i for part in pieces(text) for i in encoding.encode_ordinary(part)]


def _mapped(df: DataFrame, keep: list[str], source: str, made: dict[str, str], make) -> DataFrame:
    """Columns ``keep`` and, per row of ``source``, what ``make()`` (called once a
    task) returns for it: one value per column of ``made`` (name to type). One pass
    through Python; output batches hold about ``BATCH_IDS`` ids, however many rows arrive at once."""
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{source}`").alias("s"))
    n = len(keep)
    schema = ", ".join([*[f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(n)],
                        *[f"m{i} {kind}" for i, kind in enumerate(made.values())]])
    arrow = {"array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
    kinds = [arrow[k] for k in made.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_row = make()
        for batch in batches:
            values, start, out, size = batch.column(n), 0, [], 0
            for at in range(batch.num_rows):
                out.append(of_row(values[at].as_py()))
                size += len(out[-1][0])
                if size >= BATCH_IDS or at == batch.num_rows - 1:
                    cols = [batch.column(i).slice(start, len(out)) for i in range(n)]
                    cols += [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:n], *[f"m{i}" for i in range(len(kinds))]])
                    start, out, size = at + 1, [], 0
            del batch, values
        release_memory()

    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"m{i}").alias(c) for i, c in enumerate(made)])


def encode(df: DataFrame, ranks: Broadcast, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns but the text, and ``ids`` (array of int): the ids of every
    row's whole text. A null or empty text has none; repeated rows stay; an empty
    table stays empty; a column called like ``ids`` is replaced."""
    def make():
        encoding, _ = encoder(ranks.value, pattern)
        return lambda t: (encode_text(encoding, t or ""),)

    return _mapped(df, [c for c in df.columns if c not in (text, ids)], text, {ids: "array<int>"}, make)


def decode(df: DataFrame, ranks: Broadcast, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded`` (binary): the raw bytes of the ids. Null ids decode to nothing."""
    def make():
        _, by_id = encoder(ranks.value, pattern)
        return lambda row: (b"".join([by_id[i] for i in row or ()]),)

    return _mapped(df, [c for c in df.columns if c != decoded], ids, {decoded: "binary"}, make)


def round_trip(df: DataFrame, ranks: Broadcast, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass through Python: all columns but the
    text, the ids, and the raw bytes the ids decode to."""
    def make():
        encoding, by_id = encoder(ranks.value, pattern)

        def of_text(t):
            found = encode_text(encoding, t or "")
            return found, b"".join([by_id[i] for i in found])
        return of_text

    return _mapped(df, [c for c in df.columns if c not in (text, ids, decoded)], text,
                   {ids: "array<int>", decoded: "binary"}, make)


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and ``decoded_sha256`` as columns."""
    return [F.size(ids).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]
