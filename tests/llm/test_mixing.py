"""Mixing: targets by an independent loop, allocation by its own laws."""

import random

from feedrecon.llm import mixing as M


def loop_targets(sizes, cap=3):
    """Share by weight; whatever exceeds a cap is reshared among the rest, until nothing does."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        goal = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if goal[s] > cap * sizes[s]}
        if not over:
            return {**{s: cap * sizes[s] for s in full}, **goal}
        full |= over


def rows(seed=0):
    rng = random.Random(seed)
    out = []
    for s, n in (("a", 400), ("b", 30), ("ä", 5), ("Z", 60), (None, 80), ("hot", 900), ("none", 3)):
        out += [(len(out) + i, " ".join(["w"] * (0 if s == "none" else rng.randrange(0, 60))), s) for i in range(n)]
    return out + [(9001, None, "a"), (9002, "", "b"), (9003, " \t\n", "Z"), (None, "one two", "a"), (17, "é\x1cx y", "a"), (17, "é\x1cx y", "a"),
                  (9004, "x " * 20000, "hot")]


def test_targets_and_shares(docs):
    got = M.mix(docs(rows())).collect()
    sizes, taken, longest = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    want = loop_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 4      # within half a document
    assert len(got) == len(rows())


def test_reruns_and_partitions_agree(docs):
    a = M.mix(docs(rows())).select("doc_id", "taken").collect()
    b = M.mix(docs(rows()).repartition(7)).select("doc_id", "taken").collect()
    order = lambda x: (x[0] is None, x[0], x[1])
    assert sorted(map(tuple, a), key=order) == sorted(map(tuple, b), key=order)


def test_mixed_documents_repeat_rows(docs):
    df = docs(rows())
    plan = {}
    for r in M.mix(df).collect():
        plan[(r.doc_id, r.source, r.size)] = plan.get((r.doc_id, r.source, r.size), 0) + r.copies
    got = M.mixed_documents(df)
    assert got.columns == df.columns
    seen = {}
    for r in got.collect():
        k = (r.doc_id, r.source, len([w for w in (r.text or "").encode().split()]))
        seen[k] = seen.get(k, 0) + 1
    assert seen == {k: n for k, n in plan.items() if n}


def test_document_weights(docs, spark):
    df = spark.createDataFrame([(i, "w " * 10, "a", 0.0 if i % 2 else 2.0) for i in range(400)],
                               "doc_id long, text string, source string, quality double")
    got = M.mix(df, doc_weight="quality", share=0.5).collect()
    assert sum(r.taken for r in got) == 2000 and all(r.taken == 0 for r in got if r.doc_id % 2)


def test_capped_source_draws_no_further_copies(docs):
    small = [(0, "", "b")] + [(i, "w " * 10, "b") for i in range(1, 11)]
    df = docs(small + [(i, "w " * 10, "a") for i in range(100, 400)])
    got = [r.copies for r in M.mix(df).collect() if r.source == "b"]
    assert got == [3] * 11                                       # the empty text too
    assert M.mixed_documents(df).where("source = 'b'").count() == 33


def test_capped_source_with_document_weights(spark):
    rows = [(i, "w " * 10, "b", 0.0 if i % 2 else 2.0) for i in range(10)] + [(i, "w " * 10, "a", 1.0) for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    got = {r.doc_id: r.copies for r in M.mix(df, doc_weight="quality").collect() if r.source == "b"}
    assert got == {i: 0 if i % 2 else 3 for i in range(10)}


def test_empty_table(docs):
    assert M.mix(docs([])).count() == 0 and M.mixed_documents(docs([])).count() == 0
