"""Line dedup against a brute-force version: every run of lines is compared with every earlier one."""

import random

import pytest

from feedrecon.llm.line_dedup import dedup_lines


def brute(rows, min_words):
    """Deleted lines per row: lines of runs with at least min_words words that occur earlier."""
    order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None})
    gone, seen = {}, {}
    texts = [(d if has else None, t, t.split("\n")) for has, d, t in order]
    weight = lambda x: max(1, len(x.split()))
    for n, (d, t, lines) in enumerate(texts):
        cut = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(lines[a:b + 1])
                if sum(map(weight, run)) >= min_words:
                    if seen.setdefault(run, (n, a)) != (n, a):
                        cut.update(range(a, b + 1))
        if t and sum(map(weight, lines)) < min_words and seen.setdefault(t, n) != n:        # a whole short document
            cut.update(range(len(lines)))
        gone[(d, t)] = cut
    return gone


def check(docs, rows, min_words):
    got = dedup_lines(docs(rows), min_words=min_words).select("doc_id", "text", "removed_lines", "removed_spans", "d", "spans").collect()
    gone = brute(rows, min_words)
    want = []
    for r in rows:
        lines = r[1].split("\n") if r[1] is not None else []
        cut = gone.get((r[0], r[1]), set())
        want.append((r[0], r[1] if not cut else "\n".join(x for i, x in enumerate(lines) if i not in cut), len(cut)))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "", x[2])
    assert sorted([(r.doc_id, r.text, r.removed_lines) for r in got], key=key) == sorted(want, key=key)
    assert all(r.d == "d!" and r.spans == "spans!" for r in got)
    for r in got:
        ends = [tuple(map(int, s.split("-"))) for s in r.removed_spans.split(",") if s]
        assert sum(b - a + 1 for a, b in ends) == r.removed_lines


@pytest.mark.parametrize("seed", range(3))
def test_random_line_sequences(docs, seed):
    rng = random.Random(seed)
    words = ["a b c", "d e", "f", "", "g h i j k l m n", "unique"]
    rows = []
    for d in range(14):
        lines = [rng.choice(words) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.5:
            lines.insert(rng.randrange(len(lines)), f"only here {d}")
        rows.append((d, "\n".join(lines)))
    rows += [(20, rows[3][1]), (21, rows[3][1] + "\nf"), (22, "a b c\n" * 40)]
    rows += [(d, t) for d, t in zip(range(30, 40), ["f", "d e\nf", "f", "", "d e\nf", "", "\n", "\n", "d e\nf\nd e", "solo"], strict=True)]
    check(docs, rows, 8)


def test_edge_cases(docs):
    long = "\n".join(f"line {i} of a very long text" for i in range(700))
    run = "one two three four\nfive six seven eight"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, run), (4, run), (5, run + "\ntail"), (None, "x\n" + run), (None, None),
            (6, long), (7, long), (8, "é è à\n" + run), (5, "other text\n" + run)]
    got = {(r.doc_id, r.removed_lines, r.text if r.text is None or len(r.text) < 40 else "long")
           for r in dedup_lines(docs(rows), min_words=8).collect()}
    # the null id comes first in corpus order and keeps the run; rows repeated with equal id and text are one document
    assert (None, 0, "x\n" + run) in got or (None, 0, "long") in got
    assert (4, 2, "") in got and (7, 700, "") in got and (6, 0, "long") in got
    assert (1, 0, None) in got and (2, 0, "") in got and (3, 0, "\n\n") in got
    assert (8, 2, "é è à") in got


def test_repeat_inside_a_document(docs):
    got = dedup_lines(docs([(1, "\n".join(["same line here"] * 40)), (2, "no repeat at all")]), min_words=9).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].removed_lines > 30 and by[1].removed_spans.endswith("-39") and by[2].removed_lines == 0


def test_empty_table(docs):
    out = dedup_lines(docs([]))
    assert out.count() == 0 and {"doc_id", "text", "removed_lines", "removed_spans"} <= set(out.columns)


def test_no_copy_of_an_equal_text_stays(spark):
    """On the given documents every group of equal texts keeps one whole text."""
    from feedrecon.llm.util import table
    docs = table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    groups = {}
    for d in sorted(before):
        if before[d]:
            groups.setdefault(before[d], []).append(d)
    copies = [ds for ds in groups.values() if len(ds) > 1]
    assert len(copies) > 50 and all(after[d] != before[d] for ds in copies for d in ds[1:])
