"""Divergence audit against plain counting with whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from feedrecon.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string, digest string, n string, docs string, part string, value string"


def plain(rows, least, top=50):
    docs = [(x or "", g or "", s or "") for x, g, s in rows]
    of = [Counter(w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(x)) for x, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [(c, s) for c, (_, g, s) in zip(of, docs, strict=True) if g == lang]
        seen = Counter(w for c, _ in mine for w in c)
        kept = {w for w, n in seen.items() if n >= least}
        by = defaultdict(Counter)
        for c, s in mine:
            by[s].update({w: n for w, n in c.items() if w in kept})
        whole = sum(by.values(), Counter())
        def share(c):
            total = sum(c.values())
            return {w: 1 + 1_000_000_000 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}
        p, q = {s: share(by[s]) for s in {s for _, s in mine}}, share(whole)
        for s in p:
            pairs = sorted([(-sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in p if o != s])
            words = sorted([(-(p[s][w] - q[w]), w) for w in kept if by[s][w] and p[s][w] > q[w]], key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", w, -v, k) for k, (v, w) in enumerate(words[:top], 1)]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in [tuple(r) for r in rows]], SCHEMA)
    return sorted(tuple(r) for r in D.divergence(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "abcdéxÉ" for b in ["", "Q", "ß", "mn", "漢", "zz", "K"]]
    out = [(" ".join(rng.choice(words[: rng.choice([5, 20, 49])]) for _ in range(rng.choice([0, 1, 8, 40]))) + rng.choice(["", "1x2", "\x00", "-"]),
            rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "é", "s10", None, "hot", "hot", "hot"])) for _ in range(300)]
    return out + [(None, "en", "quiet"), ("", "only", "one"), ("??", "none", "a"), (None, "none", "b"), ("Mi " * 20_000 + "x" * 100_000, "fr", "long")] + out[:20]


def test_against_plain_counts(spark, rows):
    assert audited(spark, rows, min_documents=12) == plain(rows, 12)


def test_small_holds_and_blocks(spark, rows):
    assert audited(spark, rows, min_documents=12, held=30, block=40) == plain(rows, 12)


@pytest.mark.parametrize("bits", [2, 5])
def test_collisions_are_split(spark, rows, bits):
    assert audited(spark, rows, min_documents=12, bits=bits) == plain(rows, 12)


def test_few_ranks_and_ties(spark):
    rows = [("alpha beta gamma delta", "en", "a"), ("alpha beta gamma delta", "en", "a"), ("omega", "en", "b")]
    assert audited(spark, rows, min_documents=1, top=2) == plain(rows, 1, 2)


def test_empty_table_and_no_kept_terms(spark, rows):
    assert audited(spark, []) == []
    got = audited(spark, rows[:30], min_documents=1000)
    assert got == plain(rows[:30], 1000) and all(r[4] == 0 and r[2] == "pair" for r in got)


def test_large_counts_stay_exact(spark):
    """Quotients beyond 64 bits in the dividend."""
    from pyspark.sql import functions as F
    cases = [(10**12, 3 * 10**15, 10**6), (0, 1, 1), (7, 9, 2), (5 * 10**15, 5 * 10**15, 1)]
    df = spark.createDataFrame(cases, "c long, t long, k long").select("*", D.share(F.col("c"), F.col("t"), F.col("k")).alias("p"))
    assert [r.p for r in df.orderBy("t").collect()] == [1 + 10**9 * (c + 5) // (t + 5 * k) for c, t, k in sorted(cases, key=lambda x: x[1])]


def test_shuffles_carry_no_text(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string").na.fill("")
    found = D.parts(df)
    from tests.plan_utils import plan_text
    plan = plan_text(found.groupBy(*D.GROUP, "digest").sum("n"))
    scan = [x for x in plan.splitlines() if "ReadSchema" in x]
    assert scan and all("string" not in x for x in scan)


def test_group_digests_that_collide_take_another_seed(spark, rows, monkeypatch):
    real = D.digests_of
    monkeypatch.setattr(D, "digests_of", lambda seed: real(seed) if seed > 1 else [c.bitwiseAND(1).alias(n) for c, n in zip(real(seed), D.GROUP, strict=True)])
    df = spark.createDataFrame(rows, "text string, lang string, source string").na.fill("")
    assert D.named_groups(df)[1] == 2
    assert audited(spark, rows[:80], min_documents=12) == plain(rows[:80], 12)
