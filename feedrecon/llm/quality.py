"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text train a
linear model on statistics of the whole text. With class prior ``p`` the risk

    p E_pos[loss(+)] + max(0, E_unl[loss(-)] - p E_pos[loss(-)])

is minimised (the non-negative unbiased estimate: unlabelled text counts as
negative, less what the positives in it contribute; the difference may not fall
below zero, else the step undoes it). The prior is estimated as the
share of good documents among the labelled ones outside the held-out fold.

Only the fit sees a sample: at most ``max_positive`` and ``max_unlabelled``
documents, by the order of a hash. Every document is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrecon.llm.util import release_memory

#: Bounds of the sample the model is fitted on (documents).
MAX_POSITIVE, MAX_UNLABELLED = 20_000, 20_000
THRESHOLD = 0.3
#: One fold in so many is held out.
FOLDS = 5
_PUNCT = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)
_CLASSES = [np.arange(65, 91), np.arange(97, 123), np.arange(48, 58), np.array([32]), np.array([10]),
            np.array([9, 11, 12, 13]), np.r_[0:9, 14:32, 127], np.arange(128, 256)]
N_FEATURES = len(_PUNCT) + len(_CLASSES) + 11


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text: shares of bytes and byte classes, words,
    repeats. An empty or null text has all zeros."""
    out = np.zeros(N_FEATURES)
    data = text.encode() if text else b""
    words = data.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    out[:len(_PUNCT)] = np.sqrt(counts[_PUNCT])
    out[len(_PUNCT):-11] = [counts[c].sum() for c in _CLASSES]
    n, sizes = len(words), np.fromiter(map(len, words), np.int64)
    distinct, lines = set(words), data.split(b"\n")
    letters = counts[65:91].sum() + counts[97:123].sum()
    out[-11:] = [
        counts[65:91].sum() / letters if letters else 0.0,      # capitals among letters
        sizes.mean() / 10, sizes.std() / 10,
        len(distinct) / n, np.log(len(distinct)) / np.log(n) if n > 1 else 1.0,
        sum(map(eq, words, words[1:])) / n,                       # a word that follows itself
        sum(map(eq, words, words[2:])) / n,
        (sizes == 1).mean(),
        1 - len(set(lines)) / len(lines),
        np.log1p(n) / 10, np.log1p(len(data) / len(lines)) / 10,
    ]
    return out


@dataclass(frozen=True)
class Model:
    """Weights on standardised features; ``score`` is the probability of being good."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
           l2: float = 1e-4) -> Model:
    """Minimise the non-negative risk with the logistic loss (Adam, whole sample)."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    w, b, m, v = np.zeros(p.shape[1]), 0.0, np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = sigmoid(zp), sigmoid(zu)
        minus = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()     # the estimated risk on negatives
        gp, gu = sp / len(p), su / len(u)                                           # slopes of loss(-)
        if minus >= 0:
            dp, du = prior * ((sp - 1) / len(p) - gp), gu
        else:
            dp, du = prior * gp, -gu
        grad = np.append(p.T @ dp + u.T @ du + l2 * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, float(b))


def held_out(key: Column) -> Column:
    """Whether a document is in the held-out fold: CRC-32 of its id as text (null: empty)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of_text(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return of_text(text)


def _sample(ids: DataFrame, n: int) -> DataFrame:
    return ids.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(n)


def _features_of(docs: DataFrame, ids: DataFrame, key: str, text: str, n: int) -> np.ndarray:
    """Features of a bounded sample of documents; the ids (at most ``n``) are broadcast."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(ids), "id", "left_semi")
    rows = rows.select(feature_column(F.col("text")).alias("x")).limit(n).toPandas()
    return np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """The model from documents and labels outside the held-out fold. Null
    ids, null labels and labels without a document are passed over. Without
    positives or documents every score is the prior (one half without labels)."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    prior = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    prior = 0.5 if prior is None else min(max(prior, 0.01), 0.99)
    every = docs.select(F.col(f"`{key}`").alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    positive = _features_of(docs, _sample(known.where("y = 1"), max_positive), key, text, max_positive)
    unlabelled = _features_of(docs, _sample(every, max_unlabelled), key, text, max_unlabelled)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), float(np.log(prior / (1 - prior))))
    return fit_pu(positive, unlabelled, prior)


def score_column(model: Model, text: Column) -> Column:
    """Score of a whole text, from the text alone."""
    @F.pandas_udf("double")
    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(np.stack([features(t) for t in texts])) if len(texts) else [], dtype=float)
        release_memory()

    return of_text(text)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` (int) for every row: 1 from
    ``threshold`` on. Empty and null texts are scored too (all features zero); repeated
    rows stay; other columns are not read. No shuffle."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), held_out(F.col(f"`{key}`")).alias("held_out"),
                       score_column(model, F.col(f"`{text}`")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, all columns kept."""
    return docs.where(score_column(model, F.col(f"`{text}`")) >= threshold)
