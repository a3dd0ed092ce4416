r"""Language identification: scripts narrow the candidates, Viterbi labels spans.

1. **Words** are runs of letters, folded to lower case. Per language the model
   holds log shares of hashed letter pairs and triples (with word borders) and the
   scripts its texts use, counted by Spark over a bounded sample of labelled documents.
2. **Candidates**: a word's script (a table of code point ranges) leaves only the languages
   whose texts use it; of a script that none uses all stay, unscored.
3. **Viterbi**: a word scores each candidate by its pairs and triples, at most ``MARGIN`` apart; going
   from one language to another costs ``SWITCH``. The best path over a text's words labels its spans, so
   passages of another language show up as spans while stray words don't. Texts are cut into
   blocks of words that are worked on side by side: each block's (max, +) matrix, the matrices
   chained, each block's path; the result is that of the plain recurrence, whatever the length.
4. A document's language is the one with the most letters; its score the mean over all its letters of
   the word's probability of that language where the span has it, else 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrecon.llm.util import release_memory, stored

#: Bound of the sample the model is fitted on: documents per language.
MAX_DOCUMENTS = 10_000
#: One fold in so many is held out.
FOLDS = 3
TRIPLES, PAIRS = 1 << 16, 1 << 13
SWITCH, MARGIN, SMOOTHING, SCRIPT_SHARE = 12.0, 8.0, 0.5, 0.01
#: Words of a block and cells (letters times languages) worked on at a time.
BLOCK, CELLS = 512, 4_000_000
UNKNOWN = "und"
#: Scripts by code point ranges (first, last). Other letters are script 0.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_COUNTS = TRIPLES + PAIRS + len(SCRIPTS) + 1


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: the folded letter (0: no letter) and the script."""
    fold = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    script = np.zeros(0x110000, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for lo, hi in ranges:
            script[lo:hi + 1] = k
    return fold, script


@dataclass(frozen=True)
class Words:
    """Words of texts laid end to end. Per letter: ``triple, pair`` (rows of the model). Per word: ``first``
    letter's number, ``letters``, ``script``, ``at`` (its place among the code points of its
    text). Per text: ``count`` of words."""
    triple: np.ndarray
    pair: np.ndarray
    first: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    at: np.ndarray
    count: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    fold, script = _tables()
    codes = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    sizes = np.fromiter((len(c) for c in codes), np.int64, len(codes))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    whole = np.zeros(int(starts[-1]) + 1, np.uint32)               # a border before, between and after
    for at, c in zip(starts, codes, strict=False):
        whole[at + 1:at + 1 + len(c)] = c
    x = fold[whole]
    letter = np.flatnonzero(x)
    a, b, c = (x[letter + d].astype(np.uint64) for d in (-1, 0, 1))
    triple = ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9)) >> np.uint64(40)) % np.uint64(TRIPLES)
    pair = ((b * np.uint64(0xD6E8FEB86659FD93) + c * np.uint64(0xA0761D6478BD642F)) >> np.uint64(40)) % np.uint64(PAIRS) + np.uint64(TRIPLES)
    new = x[letter - 1] == 0
    first = np.flatnonzero(new)
    begin = letter[first]
    text = np.searchsorted(starts, begin, side="right") - 1
    return Words(triple.astype(np.int64), pair.astype(np.int64), first, np.diff(np.append(first, len(letter))),
                 script[whole[begin]], begin - starts[text] - 1, np.bincount(text, minlength=len(codes))[:len(codes)])


@dataclass(frozen=True)
class Model:
    """``table``: log shares, hashed pairs and triples x languages; ``uses``: scripts x languages."""
    langs: list[str]
    table: np.ndarray
    uses: np.ndarray

    def emissions(self, w: Words) -> np.ndarray:
        """Words x languages, 0 for the best candidate, at least -MARGIN; -inf for no candidate."""
        if not len(w.first):
            return np.zeros((0, len(self.langs)), np.float32)
        per = self.table[w.triple] + self.table[w.pair]
        score = np.add.reduceat(per, w.first, axis=0)
        uses = self.uses[w.script]
        known = uses.any(axis=1)
        score[~known] = 0
        score[known[:, None] & ~uses] = -np.inf
        best = score.max(axis=1, keepdims=True)
        return np.where(np.isneginf(score), score, np.maximum(score - best, -MARGIN)).astype(np.float32)


def viterbi(e: np.ndarray, count: np.ndarray, switch: float = SWITCH, block: int = BLOCK) -> np.ndarray:
    """The best path's state for every word; ``e``: words x states, texts end to end, ``count`` words each.
    Ties go to the state that stays, then to the smaller one."""
    n, k = e.shape
    if not n:
        return np.zeros(0, np.int64)
    blocks = -(-count // block)
    text_of = np.repeat(np.arange(len(count)), blocks)
    nth = np.arange(len(text_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = (np.cumsum(count) - count)[text_of] + nth * block
    size = np.minimum(count[text_of] - nth * block, block)
    order = np.argsort(-size, kind="stable")
    active = [int(np.searchsorted(-size[order], -t, side="left")) for t in range(int(size.max()))]   # blocks longer than t

    def forward(v, back=None):
        """Costs after each block from those before it (in ``order``); ``back``: where each state came from."""
        for t, m in enumerate(active):
            top = v[:m].max(axis=-1, keepdims=True) - switch
            at = start[order[:m]] + t
            if back is not None:
                back[0][at], back[1][at] = v[:m] >= top, v[:m].argmax(axis=-1)
            v[:m] = np.maximum(v[:m], top) + (e[at] if v.ndim == 2 else e[at][:, None, :])
        return v

    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.zeros((len(order), k))
    longer = np.flatnonzero(nth > 0)
    if len(longer):
        through = forward(np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(len(order), axis=0))
        for b in longer:                                  # a text's blocks one after the other
            v = (before[place[b - 1]][:, None] + through[place[b - 1]]).max(axis=0)
            before[place[b]] = v - v.max()
    stay, top = np.zeros((n, k), bool), np.zeros(n, np.int64)
    after = forward(before, (stay, top))
    path = np.zeros((n, k), np.int16)                     # per end state of its block
    state = np.tile(np.arange(k, dtype=np.int16), (len(order), 1))
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = start[order[:m]] + t
        path[at] = state[:m]
        state[:m] = np.where(np.take_along_axis(stay[at], state[:m].astype(np.int64), axis=1), state[:m], top[at][:, None])
    end = after.argmax(axis=1)
    for b in longer[::-1]:
        end[place[b - 1]] = state[place[b], end[place[b]]]
    return path[np.arange(n), np.repeat(end[place], size)].astype(np.int64)


def _chunks(texts: list[str | None], cells: int, width: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of a bounded size (one text at least)."""
    lo = held = 0
    for i, t in enumerate(texts):
        n = len(t or "") * width
        if i > lo and held + n > cells:
            yield lo, i
            lo, held = i, 0
        held += n
    if texts:
        yield lo, len(texts)


def label(model: Model, texts: list[str | None]) -> Iterator[tuple[list[dict], str, float]]:
    """Per text: spans (``start, end`` in characters, ``lang``), language, score."""
    k = len(model.langs)
    for lo, hi in _chunks(texts, CELLS, max(k, 1)):
        w = words_of(texts[lo:hi])
        if not k:
            yield from (([], UNKNOWN, 0.0) for _ in range(lo, hi))
            continue
        e = model.emissions(w)
        path = viterbi(e, w.count)
        weight = np.exp(e, where=~np.isneginf(e), out=np.zeros_like(e))
        sure = weight[np.arange(len(path)), path] / weight.sum(axis=1) if len(path) else np.zeros(0)
        text = np.repeat(np.arange(hi - lo), w.count)
        letters = np.zeros((hi - lo, k))
        np.add.at(letters, (text, path), w.letters)
        mass = np.zeros((hi - lo, k))
        np.add.at(mass, (text, path), w.letters * sure)
        best = letters.argmax(axis=1)
        cut = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (text[1:] != text[:-1])))) if len(path) else np.zeros(0, int)
        last = np.append(cut[1:], len(path)) - 1 if len(cut) else cut
        bounds = np.searchsorted(text[cut], np.arange(hi - lo + 1))
        begin, finish, lang = w.at[cut], w.at[last] + w.letters[last], path[cut]
        for i in range(hi - lo):
            total = letters[i].sum()
            if not total:
                yield [], UNKNOWN, 0.0
                continue
            s = slice(bounds[i], bounds[i + 1])
            spans = [{"start": int(x), "end": int(y), "lang": model.langs[z]} for x, y, z in zip(begin[s], finish[s], lang[s], strict=True)]
            yield spans, model.langs[best[i]], float(min(1.0, mass[i, best[i]] / total))


def held_out(key: Column) -> Column:
    """Whether a document is in the held-out fold: CRC-32 of its id as text (null: empty)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 1


def counts(texts: list[str | None]) -> np.ndarray:
    """Occurrences of hashed triples and pairs, and letters per script (by a word's first letter)."""
    w = words_of(texts)
    out = np.bincount(w.triple, minlength=TRIPLES + PAIRS) + np.bincount(w.pair, minlength=TRIPLES + PAIRS)
    return np.concatenate([out, np.bincount(w.script, weights=w.letters, minlength=len(SCRIPTS) + 1).astype(np.int64)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, slot, n`` of a task's documents; what it holds is bounded by languages x slots."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        by_lang: dict[str, list] = {}
        for lang, text in zip(*[(v.as_py() for v in batch.column(c)) for c in ("lang", "text")], strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for lo, hi in _chunks(texts, CELLS, 4):
                total[lang] = total.get(lang, 0) + counts(texts[lo:hi])
    for lang, n in total.items():
        slot = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int32()),
                                          pa.array(n[slot], pa.int64())], names=["lang", "slot", "n"])
    release_memory()


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_documents: int = MAX_DOCUMENTS) -> Model:
    """The model from text and language of documents outside the held-out fold: of every language the
    ``max_documents`` first by a hash of the id. Null ids and null languages teach nothing; a language
    whose texts have no letter is not learned; repeated rows count as often as they stand. The model has one
    row per slot and language: the driver gets no more, however many documents there are."""
    name, group = F.col(f"`{key}`"), F.col(f"`{lang}`")
    known = docs.select(name.alias("id"), group.alias("lang")).where(name.isNotNull() & group.isNotNull() & ~held_out(name))
    best = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = stored(known.distinct().withColumn("place", F.row_number().over(best)).where(F.col("place") <= max_documents).select("id", "lang"), "language-sample")
    rows = (docs.select(name.alias("id"), group.alias("lang"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(ids), ["id", "lang"], "left_semi").select("lang", "text"))       # ids: at most the bound per language
    found = (rows.mapInArrow(_counted, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    langs, per = [], []
    for value, group_rows in sorted(found.groupby("lang")):
        n = np.zeros(N_COUNTS, np.int64)
        n[group_rows["slot"].to_numpy()] = group_rows["n"].to_numpy()
        if n[TRIPLES + PAIRS:].sum():
            langs.append(value)
            per.append(n)
    if not langs:
        return Model([], np.zeros((TRIPLES + PAIRS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    per = np.stack(per, axis=1).astype(float)
    table = np.empty((TRIPLES + PAIRS, len(langs)), np.float32)
    for at in (slice(0, TRIPLES), slice(TRIPLES, TRIPLES + PAIRS)):
        some = per[at] + SMOOTHING
        table[at] = np.log(some / some.sum(axis=0))
    letters = per[TRIPLES + PAIRS:]
    return Model(langs, table, letters >= SCRIPT_SHARE * letters.sum(axis=0))


_SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans, lang, score`` of every row: spans of one language with places in characters, the
    language with the most letters, a score from 0 to 1.

    A null or empty text, or one without a letter, is ``und`` with score 0 and no span, as is every text
    under a model that learned nothing; equal letters go to the smaller language name; null ids and repeated rows stay;
    an empty table gives an empty result; other columns are not read. No shuffle; texts are read whole."""
    share = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, langs, scores = [], [], []
            for s, lang, score in label(share.value, batch.column("text").to_pylist()):
                spans.append(s)
                langs.append(lang)
                scores.append(score)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "spans", "lang", "score"])
        release_memory()

    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, spans {_SPANS}, lang string, score double")


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from the text alone."""
    return identify(docs, model, key, text).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lang").alias("lang_pred"), "score")
