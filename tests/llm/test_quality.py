"""PU classifier: held-out accuracy, no leak of the held-out fold, edge cases."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedrecon.llm import quality as Q
from feedrecon.llm.util import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = Q.score(docs, Q.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    test = [r for r in got if r.held_out]
    assert len(test) > 50 and np.mean([r.predicted == r.quality for r in test]) >= 0.95


def test_held_out_labels_do_not_matter(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit(docs, labels), Q.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_negative_labels_are_not_trained_on(spark):
    """Only positives, unlabelled text and the prior: a model from unlabelled text alone still parts the classes."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (900, 5)), rng.normal(-2, 1, (100, 5))
    model = Q.fit_pu(good[:400], np.concatenate([good[400:], bad]), 500 / 600)
    assert (model.score(good) >= 0.3).mean() > 0.97 and (model.score(bad) < 0.3).mean() > 0.75     # 400 positives in 5 dimensions


def test_risk_is_kept_non_negative():
    """A flexible model on few points cannot drive the negative part far below zero."""
    rng = np.random.default_rng(1)
    model = Q.fit_pu(rng.normal(0.1, 1, (15, 40)), rng.normal(0, 1, (15, 40)), 0.9, l2=0.0)
    assert np.isfinite(model.weights).all()


def test_edge_cases(spark, docs):
    rows = [(i, "good plain words in a row " + str(i)) for i in range(40)] + [(40, None), (41, ""), (42, " \n"), (None, "x"), (1, "again"),
                                                                          (43, "é" * 100000), (44, "w " * 50000)]
    df = docs(rows)
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 1), (2, None), (999, 0)], "doc_id long, quality int")
    model = Q.fit(df, labels)
    got = Q.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert Q.keep_good(df, model).columns == df.columns
    none = Q.fit(df, labels.limit(0))
    assert {r.score for r in Q.score(df, none).collect()} == {0.5}
    assert Q.score(docs([]), Q.fit(docs([]), labels)).count() == 0


def test_features_see_the_whole_text():
    a = Q.features("plain words here " * 30000)
    assert not np.array_equal(a, Q.features("plain words here " * 30000 + "| " * 30000))
    assert not Q.features("").any() and not Q.features(None).any()


def plain_features(text):
    """The statistics one by one, from their definitions."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * Q.N_FEATURES
    share = lambda chosen: sum(b in chosen for b in data) / len(data)
    out = [share({p}) ** 0.5 for p in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
    upper, lower = set(range(65, 91)), set(range(97, 123))
    out += [share(c) for c in (upper, lower, set(range(48, 58)), {32}, {10}, {9, 11, 12, 13}, set(range(9)) | set(range(14, 32)) | {127}, set(range(128, 256)))]
    letters, n, sizes, lines = share(upper) + share(lower), len(words), [len(w) for w in words], data.split(b"\n")
    mean = sum(sizes) / n
    out += [share(upper) / letters if letters else 0.0, mean / 10, (sum((s - mean) ** 2 for s in sizes) / n) ** 0.5 / 10, len(set(words)) / n,
            math.log(len(set(words))) / math.log(n) if n > 1 else 1.0, sum(words[i] == words[i + 1] for i in range(n - 1)) / n,
            sum(words[i] == words[i + 2] for i in range(n - 2)) / n, sum(s == 1 for s in sizes) / n, 1 - len(set(lines)) / len(lines),
            math.log1p(n) / 10, math.log1p(len(data) / len(lines)) / 10]
    return out


def test_features_one_by_one():
    for t in [None, "", " ", "a", "A b a b a", "Hello, World!\nHello, World!\n\n1 2 3", "é È ü\tx\x01\x7f", "|| -- ## " * 50, "w" * 5000]:
        assert np.allclose(Q.features(t), plain_features(t))


def plain_fit(positive, unlabelled, prior, steps, rate, l2):
    """The non-negative risk by sums over single documents; slopes by difference quotients."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = ([list(np.clip((x - mean) / scale, -6, 6)) for x in part] for part in (positive, unlabelled))
    k = positive.shape[1]

    def loss(w, x, sign):
        return math.log1p(math.exp(-sign * (sum(a * b for a, b in zip(w, x, strict=False)) + w[-1])))

    def parts(w):
        plus = sum(loss(w, x, 1) for x in p) / len(p)
        minus = sum(loss(w, x, -1) for x in u) / len(u) - prior * sum(loss(w, x, -1) for x in p) / len(p)
        return prior * plus, minus

    w, m, v = [0.0] * (k + 1), [0.0] * (k + 1), [0.0] * (k + 1)
    for t in range(1, steps + 1):
        plus, minus = parts(w)
        # at or above zero the whole risk falls; below it the negative part is led back
        target = (lambda z: sum(parts(z))) if minus >= 0 else (lambda z: -parts(z)[1])
        grad = []
        for i in range(k + 1):
            up, down = list(w), list(w)
            up[i], down[i] = w[i] + 1e-5, w[i] - 1e-5
            grad.append((target(up) - target(down)) / 2e-5 + (l2 * w[i] if i < k else 0))
        for i, g in enumerate(grad):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            w[i] -= rate * (m[i] / (1 - 0.9 ** t)) / ((v[i] / (1 - 0.999 ** t)) ** 0.5 + 1e-8)
    return np.array(w)


@pytest.mark.parametrize("seed,prior", [(0, 0.5), (1, 0.85), (2, 0.97)])
def test_fit_against_a_plain_version(seed, prior):
    rng = np.random.default_rng(seed)
    good, other = rng.normal(1, 1, (20, 3)), np.concatenate([rng.normal(1, 1, (12, 3)), rng.normal(-1, 1, (8, 3))])
    model = Q.fit_pu(good, other, prior, steps=60)
    assert np.allclose([*model.weights, model.bias], plain_fit(good, other, prior, 60, 0.05, 1e-4), atol=2e-3)
