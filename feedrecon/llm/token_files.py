"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id; every partition encodes its
texts and writes, under a name of its own attempt,

* ``<name>.bin``: the ids of all its documents, little-endian unsigned, 16 bits wide
  if the vocabulary fits and 32 otherwise;
* ``<name>.idx``: n + 1 little-endian 64-bit offsets (in ids) of its n documents;
* ``<name>.key``: the n document ids, 64-bit (``NULL_KEY``: null).

The manifest (one row per partition, written through Spark, so only files of
attempts that counted are in it) holds the counts; the base of each partition
is a prefix sum over the manifest. Readers map the files into memory.

Encoding: the tokenizers library encodes the words; a word's ids are looked up
when it was met before. That is exact for the kind of tokenizer that drops
white space and merges inside words only, which is recognised by its file
(``keeps_words_apart``); any other gets its texts whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedrecon.llm.util import release_memory, stored

NULL_KEY = -2 ** 63
MAX_TOKENIZER_BYTES = 64 << 20
#: Words kept with their ids in a worker; beyond it the table starts anew.
CACHE_WORDS = 400_000
#: Characters of text encoded at once, and documents read back at once.
TEXT_BATCH, READ_DOCS = 1 << 20, 50_000
WORDS_AT_ONCE = 4096
#: Tasks that read files back, at most; beyond it a task reads several slices.
MAX_READERS = 10_000
# FIXED VALUE: the pattern of the kind of tokenizer whose words are looked up one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Lower-case letters that normalising leaves as they are.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
#: A word of such letters, maybe with signs after it (no apostrophe, and no sign a special token starts with).
_PLAIN = re.compile(rf"([{LETTERS}]+)([!-&(-/:;=-@\[-`{{-~]*)")
MANIFEST = "part int, file string, width int, n_docs long, n_ids long"
_LOADED: dict = {}


def load_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file of the tokenizers library, as a broadcast of proven size."""
    with open(path, "rb") as f:
        data = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"tokenizer file over {MAX_TOKENIZER_BYTES} bytes: {path}")
    return spark.sparkContext.broadcast(data)


class WordEncoder:
    """Whole-text ids by the tokenizers library, as bytes of flat unsigned integers."""

    def __init__(self, data: bytes, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.cache: dict[bytes, bytes] = {}
        self.cache_words = cache_words
        self.signs: dict[str, bytes] = {}
        by_byte = ByteLevel(add_prefix_space=False, use_regex=False)          # how the model spells a letter's bytes
        self.spelling = {ord(c): by_byte.pre_tokenize_str(c)[0][0] for c in LETTERS}
        self.model, self.code = self.tokenizer.model, "H" if self.width == 2 else "I"     # native order: little-endian hosts
        self.by_word = self.keeps_words_apart()

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, straight from the library."""
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def keeps_words_apart(self) -> bool:
        """Whether the file is of the kind whose words can be looked up: white space is dropped, A-Z read as a-z,
        and letters, digits and other signs never merge."""
        spec = json.loads(self.tokenizer.to_str())
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        kinds = [n["type"] for n in norm.get("normalizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0]
        added = [t["content"] for t in spec["added_tokens"]]
        return (kinds == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": WORD_PATTERN}
                and split.get("invert") and split.get("behavior") == "Removed" and spec["model"]["type"] == "BPE"
                and all(t.startswith("<") and not any(c.isspace() for c in t) for t in added))

    def _word_ids(self, word: bytes) -> bytes | None:
        """Ids of a word of plain letters by the library's BPE model alone (nothing
        is left to normalise or split), with plain signs after it; None for any other word."""
        m = _PLAIN.fullmatch(word.decode())
        if not m:
            return None
        core, signs = m.groups()
        ids = self.cache.get(core.encode()) if signs else None
        if ids is None:
            spelled = core if core.isascii() else core.translate(self.spelling)
            ids = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if signs:
            if signs not in self.signs:
                if len(self.signs) > self.cache_words:
                    self.signs.clear()
                self.signs[signs] = self._ids([signs])[0]
            ids += self.signs[signs]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._ids(texts)
        # A-Z as a-z finds more words again; not where a special token might stand, which the library takes as written
        split = [(d if b"<" in (d := t.encode()) else d.lower()).split() for t in texts]
        here = set().union(*split)
        new = here - self.cache.keys()
        if len(self.cache) + len(new) > self.cache_words:       # keep what this batch uses
            self.cache = {w: self.cache[w] for w in here if w in self.cache}
        rest = []
        for w in new:
            ids = self._word_ids(w)
            if ids is None:
                rest.append(w)
            else:
                self.cache[w] = ids
        for at in range(0, len(rest), WORDS_AT_ONCE):
            part = rest[at:at + WORDS_AT_ONCE]
            self.cache.update(zip(part, self._ids([w.decode() for w in part]), strict=True))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]


def _encoder(data: bytes) -> WordEncoder:
    key = hash(data)
    if key not in _LOADED:
        _LOADED[key] = WordEncoder(data)
    return _LOADED[key]


def file_system(uri: str):
    """(pyarrow file system, path) of a folder or file URI. Spark's ``s3a:`` and ``s3n:`` are Arrow's ``s3:``; ``hdfs:``
    needs libhdfs on the executors."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def read_flat(uri: str, dtype: np.dtype, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Items ``lo`` to ``hi`` of a flat file: mapped into memory on a mounted file
    system, else those bytes alone are read."""
    from pyarrow import fs
    system, path = file_system(uri)
    if isinstance(system, fs.LocalFileSystem):
        size = system.get_file_info(path).size // dtype.itemsize
        return np.memmap(path, dtype, "r")[lo:hi] if size else np.zeros(0, dtype)
    with system.open_input_file(path) as f:
        end = f.size() // dtype.itemsize if hi is None else hi
        return np.frombuffer(f.read_at((end - lo) * dtype.itemsize, lo * dtype.itemsize), dtype)


def _text_batches(batch: pa.RecordBatch) -> Iterable[tuple[list, list[str]]]:
    keys, texts, size = [], [], 0
    for key, text in zip(batch.column("key").to_pylist(), batch.column("t"), strict=True):
        keys.append(NULL_KEY if key is None else key)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= TEXT_BATCH:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def ranges(rows: DataFrame) -> int | None:
    """Ranges of ``RANGE_BYTES`` if that is more than a shuffle has (adaptive execution can't split a
    range); None where the plan's size is unknown or small."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = -(-size // RANGE_BYTES)
    return n if int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) < n < MAX_RANGES else None


#: Bytes of the input (as its plan states them) to a range, and ranges that no real table exceeds.
RANGE_BYTES, MAX_RANGES = 256 << 20, 10_000_000


def write_token_files(df: DataFrame, folder: str, tokenizer: Broadcast, end_id: int | None = 1,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id`` to each
    document, write the files under ``folder`` in ascending ``key`` order
    (nulls first, then by the text's hash) and return the manifest with ``first_id`` and
    ``first_doc``, the ids and documents of all files before.

    Keys must be integers. Repeated rows are documents of their own; an empty
    table has an empty manifest; other columns are not read."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    # dealt by narrow columns: the sample that sets the ranges holds no text; rows equal in both are told apart,
    # so that even they are dealt over several ranges
    rows = rows.withColumn("tie", F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("t"), F.col("tie")]
    n = ranges(rows)
    rows = (rows.repartitionByRange(n, *order) if n else rows.repartitionByRange(*order)).sortWithinPartitions(*order).drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, name = TaskContext.get().partitionId(), None
        enc, end, n_docs, n_ids = _encoder(tokenizer.value), b"", 0, 0
        if end_id is not None:
            end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for keys, texts in _text_batches(batch):
                if name is None:
                    system, path = file_system(folder)
                    system.create_dir(path, recursive=True)
                    name = f"part-{part:05d}-{uuid.uuid4().hex}"
                    ids, idx, doc = (system.open_output_stream(f"{path}/{name}.{x}") for x in ("bin", "idx", "key"))
                    idx.write(np.zeros(1, "<i8").tobytes())
                encoded = [x + end for x in enc.encode(texts)]
                ends = n_ids + np.cumsum([len(x) // enc.width for x in encoded])
                ids.write(b"".join(encoded))
                idx.write(ends.astype("<i8").tobytes())
                doc.write(np.array(keys, "<i8").tobytes())
                n_docs, n_ids = n_docs + len(keys), int(ends[-1])
        if name is not None:
            for f in (ids, idx, doc):
                f.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "width": enc.width, "n_docs": n_docs, "n_ids": n_ids}],
                                             pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()),
                                                        ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
        release_memory()

    manifest = stored(rows.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row per partition
    return manifest.select("*", *[F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long").alias(first)
                                  for n, first in (("n_ids", "first_id"), ("n_docs", "first_doc"))],
                           F.lit(folder).alias("folder"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id, start`` (ids of all
    documents before it), ``n_tokens, ids_crc32`` (of its ids as little-endian
    unsigned 32-bit integers). Files are read in slices of ``READ_DOCS``
    documents, spread over the cluster."""
    slices = manifest.select("folder", "file", "width", "first_id", "n_docs", F.explode(
        F.sequence(F.lit(0), F.col("n_docs") - 1, F.lit(READ_DOCS))).alias("lo"))
    # a slice is a short row but much work: a stated number of tasks, which adaptive execution does not merge
    n = manifest.agg(F.sum(F.ceil(F.col("n_docs") / F.lit(READ_DOCS)))).first()[0] or 0
    slices = slices.repartition(int(min(max(n, 1), MAX_READERS)), F.col("file"), F.col("lo"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                name, lo, hi = f"{s['folder']}/{s['file']}", s["lo"], min(s["lo"] + READ_DOCS, s["n_docs"])
                ends = np.asarray(read_flat(f"{name}.idx", np.dtype("<i8"), lo, hi + 1))
                keys = np.asarray(read_flat(f"{name}.key", np.dtype("<i8"), lo, hi))
                ids, at = read_flat(f"{name}.bin", np.dtype(f"<u{s['width']}"), int(ends[0]), int(ends[-1])), ends - ends[0]
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=keys == NULL_KEY), pa.array(ends[:-1] + s["first_id"]),
                     pa.array(np.diff(ends)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return slices.mapInArrow(read, schema)
