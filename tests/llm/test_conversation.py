"""Conversation repair against a forward recurrence over whole paths."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedrecon.llm import conversation as C
from feedrecon.llm.util import table

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, place string, conv string, edits string"


def plain_paths(turns):
    """turns: (initial, fault, role, text); the least (cost, audit) and the kept turns."""
    z = {"0": (0, "", ())}
    role = {"u": "user", "a": "assistant"}

    def put(out, state, path):
        if state not in out or path[:2] < out[state][:2]:
            out[state] = path

    def grown(state, letter):
        return {"s": {"0": "s"}, "u": {"0": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}.get(letter, {}).get(state)

    def inserted(z):
        for _ in range(2):
            out = dict(z)
            for q, (c, a, r) in z.items():
                for x in "ua":
                    if grown(q, x):
                        put(out, grown(q, x), (c + 5, a + "I", (*r, f"{role[x]}:")))
            z = out
        return z

    for initial, fault, name, text in turns:
        out, extra = {}, 5 * (fault == "truncated")
        for q, (c, a, r) in inserted(z).items():
            put(out, q, (c + 2, a + "D", r))
            if fault in ("blank", "duplicate"):
                continue
            if grown(q, initial):
                put(out, grown(q, initial), (c + extra, a + "K", (*r, f"{name}:{text}")))
            for x in "ua":
                if grown(q, x):
                    put(out, grown(q, x), (c + 1 + extra, a + "R", (*r, f"{role[x]}:{text}")))
        z = out
    z = inserted(z)
    return min((z[q] for q in ("0", "a") if q in z), key=lambda p: p[:2])


def plain_audit(rows):
    """rows: (conv_id, turn, role, text), damaged already."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([(t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).hexdigest(), x or "", t) for c, t, r, x in rows if c == conv])
        seen, turns = set(), []
        for _, _, r, _, x, _ in mine:
            bare = x.rstrip(SPACE)
            fault = "blank" if not x.strip(SPACE) else "duplicate" if (r, x) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((r, x))
            turns.append((r[:1] if r[:1] in "sua" else "?", fault, r, x))
        cost, audit, kept = plain_paths(turns)
        numbers = [m[5] for m in mine if m[5] is not None]
        faults = Counter(t[1] for t in turns)
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                     sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def audited(spark, rows, damaged=None):
    def frame(x):
        return spark.createDataFrame([(*r, "place!", "conv!", "edits!") for r in x], SCHEMA)
    got = C.audit(frame(rows), frame(rows if damaged is None else damaged))
    return {r[0]: tuple(r[1:]) for r in got.collect()}


def random_rows(rng, conv, n):
    texts = ["Hi.", "Hi", "", " \t", "Oh! ", "What?\n", "é", "Ünd.", "x.y"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u2", None]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice([*texts, f"t{i}.", f"t{i}."])) for i in range(n)]


def test_steps_against_whole_paths():
    rng = random.Random(3)
    faults = ["", "blank", "truncated"]
    for n in [0, 1, 2, 3, 5, 9, 17, 40] * 25:
        turns = [(rng.choice("suasua?"), rng.choice(faults), "r", "t") for _ in range(n)]
        symbols = bytes(4 * faults.index(f) + "sua?".index(i) for i, f, _, _ in turns)
        total, costs = C.pull_back(symbols, C.END)
        edits, state = "", 0
        for (e, start), s in zip(C.walk(symbols, C.END, 0), symbols, strict=True):
            assert start == state
            edits, state = edits + e, C.roles_after(start, e, s % 4)[-1][1]
        cost, audit, _ = plain_paths(turns)
        assert (total + costs[0], edits + C.closing(state)) == (cost, audit)
        assert C.matrix(symbols)[0][0] >= cost


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = [r for c in [None, *range(60)] for r in random_rows(rng, c, rng.choice([1, 2, 3, 6, 12]))]
    rows += rows[:5]
    assert audited(spark, rows) == plain_audit(rows)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 7, 1500) + random_rows(rng, 8, 4) + random_rows(rng, 6, 300) + [(9, 1, "user", "same.")] * 400
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        placed = C.ordered(df)
        assert placed.where("conv_id = 7").select("part").distinct().count() > 2
        assert placed.where("conv_id = 9").select("part").distinct().count() > 1        # equal rows are dealt, too
        assert audited(spark, rows) == plain_audit(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_script_is_the_real_output(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Why?"), (1, 3, "user", "Why?"), (1, 4, "assistant", "cut")]
    fixed = C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r.edit, r.role, r.text) for r in fixed.script.orderBy("place", "step").collect()]
    cost, audit, kept = plain_paths([("s", "", *rows[0][2:]), ("a", "", *rows[1][2:]), ("u", "", *rows[2][2:]), ("u", "duplicate", *rows[3][2:]), ("a", "truncated", *rows[4][2:])])
    assert "".join(e for e, _, _ in got) == audit and [f"{r}:{t}" for e, r, t in got if e != "D"] == list(kept)
    assert all(t is None and r is None for e, r, t in got if e == "D")
    assert sum(r.cost for r in fixed.turns.collect()) == cost


def test_nothing_left_and_empty_table(spark):
    gone = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert audited(spark, [(1, 2, "user", "a."), (None, 1, "user", "b.")], []) == {1: gone, None: gone}
    assert audited(spark, []) == {}


def test_very_long_texts(spark):
    rows = [(1, 1, "user", "word " * 200_000 + "end."), (1, 2, "assistant", " " * 500_000), (1, 3, "assistant", "." + "x " * 200_000)]
    assert audited(spark, rows) == plain_audit(rows)


def test_damage(spark):
    import zlib
    rows = [(c, t, "user" if t % 2 else None, f"a.b!c?{t}." if t % 3 else None) for c in [None, 1, 2] for t in range(40)] + [(3, None, "assistant", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        r = "user" if kind == 4 else r
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        want += [(c, t, r, x)] * (2 if kind == 3 else 1)
    assert sorted(map(repr, map(tuple, C.damage(df).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_conversations_table(spark, sf):
    turns = table(spark, f"/root/testdata/{sf}", "conversations", "conv_id", "turn", "role", "text")
    damaged = C.damage(turns)
    got = {r[0]: tuple(r[1:]) for r in C.audit(turns, damaged).collect()}
    want = plain_audit([tuple(r) for r in damaged.collect()])
    assert {k: got[k] for k in want} == want and len(got) == turns.select(F.col("conv_id")).distinct().count()
