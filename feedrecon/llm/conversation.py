r"""Conversation structure repair: cheapest edits by a square-root checkpointed DP.

A repaired conversation has role initials ``(s?(ua)+)?``. Turns may be kept (0),
given the role user or assistant (1), deleted (2; a must for blank and duplicate
turns), and empty user or assistant turns inserted anywhere (5); a truncated turn that
stays adds 5. Of the cheapest edits the ASCII-least string of initials (D, I, K, R) is taken.

1. **Order**: turns are range-partitioned and sorted by (conversation, turn, role,
   text digest) and stored once with their row number; so a conversation of any
   size lies over as many partitions as it needs. A *segment* is what one
   partition holds of one conversation.
2. **Symbols**: a turn is one byte (initial and fault). The first row of equal role and
   text comes from one aggregate per (conversation, role, digest) and is met by its
   row number, so no hot key is joined.
3. **DP**: the four costs-to-go before a turn (nothing yet, after s, after u, after
   a) follow from those after it. Inside a segment of n turns the vectors are kept only at every
   ceil(sqrt n)-th turn; walking forward each block's vectors are computed again
   from its checkpoint and the first tight edit in ASCII order is emitted. Steps are
   memoised on (symbol, relative costs), of which there are few.
4. **Conversations over several partitions** (at most two segments a partition end
   at a border): each such segment gives its 4 x 4 cost matrix, the matrices are folded
   backward to the costs after each segment, the forward walk gives the state in which each
   segment ends, folded forward to the states in which they start. Then all segments
   are walked alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import inf, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from feedrecon.llm.util import WORD, release_memory, stored

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The state after the role that may come next (u, u, a, u).
FLIP = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: A kept turn's initial (0 s, 1 u, 2 a, 3 other) -> state before -> state after.
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
NO_FAULT, MUST_GO, CUT = 0, 1, 2
#: Costs when no turn is left: the pending assistant, or user and assistant, are inserted.
END = (0, 2 * INSERT, INSERT, 0)


def _row_costs(symbol: int, after: tuple) -> list[list[tuple]]:
    """Per state the edits of one turn, as (initial, cost, state after), in ASCII order without inserts."""
    initial, fault = symbol % 4, symbol // 4
    extra = TRUNCATED if fault == CUT else 0
    out = []
    for q in range(4):
        edits = [("D", DELETE, q)]
        if fault != MUST_GO:
            if q in KEPT[initial]:
                edits.append(("K", extra, KEPT[initial][q]))
            edits.append(("R", REROLE + extra, FLIP[q]))
        out.append([(e, c, to) for e, c, to in edits if after[to] < inf])
    return out


def _before(symbol: int, after: tuple) -> list:
    """Costs-to-go before a turn, inserts before it included."""
    row = [min((c + after[to] for _, c, to in edits), default=inf) for edits in _row_costs(symbol, after)]
    one = [min(row[q], INSERT + row[FLIP[q]]) for q in range(4)]
    return [min(row[q], INSERT + one[FLIP[q]]) for q in range(4)]


@lru_cache(maxsize=None)      # relative costs are few: no state costs over two inserts and a delete more than the next
def before(symbol: int, after: tuple) -> tuple[int, tuple]:
    """The least cost before a turn and the four costs relative to it."""
    costs = _before(symbol, after)
    low = min(costs)
    return low, tuple(c - low for c in costs)


@lru_cache(maxsize=None)
def choose(symbol: int, after: tuple, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits of one turn (inserts before it first) and the state they lead to."""
    rows, costs = _row_costs(symbol, after), _before(symbol, after)
    done = ""
    while True:
        tight = [(e, to) for e, c, to in rows[state] if c + after[to] == costs[state]]
        if tight and tight[0][0] == "D":
            return done + "D", tight[0][1]
        if INSERT + costs[FLIP[state]] == costs[state]:
            done, state = done + "I", FLIP[state]
        else:
            return done + tight[0][0], tight[0][1]


def pull_back(symbols: bytes, after: tuple) -> tuple[float, tuple]:
    """Least cost and relative costs before a run of turns, from those after it."""
    total = 0
    for s in reversed(symbols):
        low, after = before(s, after)
        total += low
    return total, after


def matrix(symbols: bytes) -> list[list[float]]:
    """``m[p][q]``: the least cost from state p before the turns to state q after them."""
    columns = []
    for q in range(4):
        total, costs = pull_back(symbols, tuple(0 if p == q else inf for p in range(4)))
        columns.append([total + c for c in costs])
    return [[columns[q][p] for q in range(4)] for p in range(4)]


def walk(symbols: bytes, after: tuple, state: int) -> Iterator[tuple[str, int]]:
    """Per turn its edits and the state they start from, by square-root
    checkpoints; ``after`` are the relative costs after the last turn."""
    step = isqrt(max(len(symbols) - 1, 0)) + 1
    blocks = [symbols[i:i + step] for i in range(0, len(symbols), step)]
    marks = []                                          # costs after each block, last block first
    for block in reversed(blocks):
        marks.append(after)
        after = pull_back(block, after)[1]
    for block in blocks:
        costs = [marks.pop()]
        for s in reversed(block[1:]):
            costs.append(before(s, costs[-1])[1])
        for s in block:
            edits, to = choose(s, costs.pop(), state)
            yield edits, state
            state = to


def end_state(symbols: bytes, after: tuple, state: int) -> int:
    """The state in which the walk over a run of turns ends."""
    for (edits, start), s in zip(walk(symbols, after, state), symbols, strict=True):
        state = roles_after(start, edits, s % 4)[-1][1]
    return state


def roles_after(state: int, edits: str, initial: int) -> list[tuple[str, int]]:
    """(initial of the edit, state after it) for one turn's edits."""
    out = []
    for e in edits:
        state = FLIP[state] if e in "IR" else KEPT[initial][state] if e == "K" else state
        out.append((e, state))
    return out


def closing(state: int) -> str:
    """The inserts after the last turn."""
    return "I" * (END[state] // INSERT)


def illegal(left: int, right: int) -> bool:
    """Whether two adjacent initials are none of su, ua, au."""
    return (left, right) not in ((0, 1), (1, 2), (2, 1))


# --- Spark side -----------------------------------------------------------------------------------

def blank(text: Column) -> Column:
    return ~text.rlike(WORD)


def truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def damage(turns: DataFrame) -> DataFrame:
    """The registered query's damage to ``conv_id, turn, role, text`` (nulls read as one blank in
    texts, roles and keys): by CRC-32 of ``conv_id:turn`` modulo 20."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest, place, part`` stored in order; ``place``
    grows along (conversation, turn with nulls first, role, text digest). Rows equal in all of them
    are told apart by a tie breaker, so that even they are dealt over partitions."""
    keyed = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "*", F.unhex(F.sha2("text", 256)).alias("digest"), F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "tie")]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return stored(rows.withColumn("place", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("place", 33).cast("int")), "ordered-turns")


def symbols(rows: DataFrame) -> DataFrame:
    """Per row of ``ordered``: ``conv`` (a key that is never null), ``part, place, fault, symbol``, stored."""
    conv = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv")
    initial = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in "sua"]), F.substring("role", 1, 1)), F.lit(0))
    facts = rows.select(conv, "part", "place", "role", "digest", blank(F.col("text")).alias("blank"),
                        truncated(F.col("text")).alias("cut"),
                        F.when(initial > 0, initial - 1).otherwise(3).cast("int").alias("initial"))
    firsts = facts.groupBy("conv", "role", "digest").agg(F.min("place").alias("first")).select("first")
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise(""))
    code = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", CUT).otherwise(NO_FAULT)
    return stored(facts.join(firsts, F.col("place") == F.col("first"), "left")
                  .select("conv", "part", "place", fault.alias("fault"), "initial")
                  .select("conv", "part", "place", "fault", (4 * code + F.col("initial")).cast("int").alias("symbol")), "turn-symbols")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """(conversation, partition, its rows) from batches sorted by place; a segment's
    few bytes a row are all that is held."""
    held: list[pd.DataFrame] = []

    def whole():
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        return rows["conv"].iloc[0], int(rows["part"].iloc[0]), rows

    for batch in batches:
        rows = batch.to_pandas()
        if not len(rows):
            continue
        conv, part = rows["conv"].to_numpy(), rows["part"].to_numpy()
        if held and (held[-1]["conv"].iloc[-1] != conv[0] or held[-1]["part"].iloc[-1] != part[0]):
            yield whole()
            held = []
        at = 0
        for cut in np.flatnonzero((conv[1:] != conv[:-1]) | (part[1:] != part[:-1])) + 1:
            held.append(rows.iloc[at:cut])
            yield whole()
            held, at = [], cut
        held.append(rows.iloc[at:])
    if held:
        yield whole()


def _bytes(rows: pd.DataFrame) -> bytes:
    return rows["symbol"].to_numpy().astype(np.uint8).tobytes()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Cost matrix and last initial of the first and the last segment of every partition."""
    def edge(conv, part, rows):
        s = _bytes(rows)
        return {"conv": conv, "part": part, "costs": [float(c) for row in matrix(s) for c in row], "last": s[-1] % 4}

    last, fresh = None, False                  # fresh: the last segment seen was emitted as its partition's first
    for conv, part, rows in _segments(batches):
        if last is None or last[1] != part:
            if last is not None and not fresh:
                yield edge(*last)
            yield edge(conv, part, rows)
            fresh = True
        else:
            fresh = False
        last = (conv, part, rows)
    if last is not None and not fresh:
        yield edge(*last)


def _rows(df: DataFrame, make, schema: str) -> DataFrame:
    """``mapInArrow`` with a generator of dicts."""
    kinds = pa.schema(to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema))

    def run(batches):
        out = []
        for x in make(batches):
            out.append(x)
            if len(out) == 1024:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kinds)
        release_memory()
    return df.mapInArrow(run, schema)


def _backward(rows: pd.DataFrame) -> pd.DataFrame:
    """For one conversation's segments the relative costs after each."""
    rows, after, out = rows.sort_values("part"), END, []
    for r in reversed(rows.to_dict("records")):
        out.append({"conv": r["conv"], "part": r["part"], "after": [float(c) for c in after], "last": r["last"], "final": not out})
        costs = [min(r["costs"][4 * p + q] + after[q] for q in range(4)) for p in range(4)]
        after = [c - min(costs) for c in costs]
    for here, previous in zip(out, out[1:], strict=False):
        here["left"] = previous["last"]
    out[-1]["left"] = -1
    return pd.DataFrame(out)[["conv", "part", "after", "left", "final"]]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The end state from every start state of each segment."""
    for conv, part, rows in _segments(batches):
        after, s = tuple(rows["after"].iloc[0]), _bytes(rows)
        yield {"conv": conv, "part": part, "ends": [end_state(s, after, q) for q in range(4)]}


def _forward(rows: pd.DataFrame) -> pd.DataFrame:
    """For one conversation's segments the state in which each starts."""
    rows, state, starts = rows.sort_values("part"), 0, []
    for ends in rows["ends"]:
        starts.append(state)
        state = int(ends[state])
    return rows.assign(start=starts)[["conv", "part", "after", "left", "final", "start"]]


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``place, edits, roles, cost, illegal`` of every turn: initials of its edits, and per edit the
    inserted or new role's initial (``-``: the turn's own)."""
    for conv, _, rows in _segments(batches):
        s, head = _bytes(rows), rows.iloc[0]
        inner = not pd.isna(head["start"])                      # a part of a longer conversation
        after = tuple(head["after"]) if inner else END
        state = int(head["start"]) if inner else 0
        left = int(head["left"]) if inner else -1
        final = bool(head["final"]) if inner else True
        edits, roles, cost, wrong = [], [], [], []
        for k, ((e, start), x) in enumerate(zip(walk(s, after, state), s, strict=True)):
            steps = roles_after(start, e, x % 4)
            if final and k == len(s) - 1:
                steps += roles_after(steps[-1][1], closing(steps[-1][1]), 3)
            edits.append("".join(e for e, _ in steps))
            roles.append("".join(("u" if to == 2 else "a") if e in "IR" else "-" for e, to in steps))
            cost.append(sum({"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[e] for e, _ in steps)
                        + (TRUNCATED if x // 4 == CUT and "D" not in edits[-1] else 0))
            wrong.append(left >= 0 and illegal(left, x % 4))
            left = x % 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["place"].to_numpy()), pa.array(edits, pa.string()), pa.array(roles, pa.string()),
             pa.array(cost, pa.int64()), pa.array(wrong, pa.bool_())], names=["place", "edits", "roles", "cost", "illegal"])


def _merged(batches: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    release_memory()


def _by_part(rows: DataFrame) -> DataFrame:
    """A partition's rows in order, in as many tasks as a shuffle has: the rows are a few bytes each, so that
    adaptive execution would put a whole table of them into one."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "part").sortWithinPartitions("part", "place")


def _borders(turns: DataFrame) -> DataFrame:
    """``conv, part, after, left, final, start`` of the segments of conversations over several
    partitions: costs after it, the initial before it, whether it is the last, the state it starts in.
    At most two rows a partition."""
    edge = _rows(_by_part(turns.select("conv", "part", "place", "symbol")), _edges,
                 "conv string, part int, costs array<double>, last int")
    edges = stored(edge, "segment-edges")
    several = edges.groupBy("conv").count().where("count > 1").select("conv")
    folded = stored(edges.join(F.broadcast(several), "conv", "left_semi").groupBy("conv").applyInPandas(
        _backward, "conv string, part int, after array<double>, left int, final boolean"), "segment-costs")
    walked = _by_part(turns.select("conv", "part", "place", "symbol").join(F.broadcast(folded.select("conv", "part", "after")), ["conv", "part"]))
    ends = _rows(walked, _ends, "conv string, part int, ends array<int>")
    return stored(folded.join(F.broadcast(ends), ["conv", "part"]).groupBy("conv").applyInPandas(
        _forward, "conv string, part int, after array<double>, left int, final boolean, start int"), "segment-starts")


@dataclass(frozen=True)
class Repair:
    """``turns``: every input turn in order with its fault, edits, cost; ``script``: one row per edit in
    order (``place, step``), with the role and text it leaves (null for D)."""
    turns: DataFrame
    script: DataFrame


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits that give every conversation of ``df`` the structure above.

    Null roles and texts are empty ones; null turns come first; turns of equal
    number are ordered by role and text digest; repeated rows are turns of
    their own (the later one a duplicate); rows with a null conversation form one conversation; an empty
    table gives empty results; other columns are not read. Texts are read whole."""
    rows = ordered(df.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                             F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")))
    turns = symbols(rows)
    borders = _borders(turns)
    edits = stored(_by_part(turns.select("conv", "part", "place", "symbol").join(F.broadcast(borders), ["conv", "part"], "left"))
                   .mapInArrow(lambda batches: _merged(_edits(batches)),
                               "place long, edits string, roles string, cost long, illegal boolean"), "turn-edits")
    out = (rows.drop("digest", "part").join(turns.select("place", "conv", "fault"), "place").join(edits, "place"))
    step = F.explode(F.sequence(F.lit(1), F.length("edits"))).alias("step")
    script = out.select("conv_id", "conv", "turn", "place", "role", "text", "edits", "roles", step)
    e, r = F.expr("substring(edits, step, 1)"), F.expr("substring(roles, step, 1)")
    script = script.select(
        "conv_id", "conv", "turn", "place", "step", e.alias("edit"),
        F.when(e == "D", F.lit(None)).when(r == "u", "user").when(r == "a", "assistant").otherwise(F.col("role")).alias("role"),
        F.when(e == "D", F.lit(None)).when(e == "I", "").otherwise(F.col("text")).alias("text"))
    return Repair(out, script)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per conversation the initials of its edits and the SHA-256 of its kept turns, as a stream."""
    conv, audit, sha, any_kept = None, [], None, False
    for batch in batches:
        for c, e, r, t in zip(*[batch.column(x).to_pylist() for x in ("conv", "edit", "role", "text")], strict=True):
            if c != conv:
                if conv is not None:
                    yield {"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}
                conv, audit, sha, any_kept = c, [], hashlib.sha256(), False
            audit.append(e)
            if e != "D":
                sha.update((("\n" if any_kept else "") + f"{r}:{t}").encode())
                any_kept = True
    if conv is not None:
        yield {"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}


def digests(script: DataFrame) -> DataFrame:
    """``conv, audit, repaired_sha256``. A SHA-256 over one conversation is sequential by nature: it is
    streamed in one task, whatever its length, and nothing but the initials is held."""
    rows = script.select("conv", "place", "step", "edit", "role", "text").repartition("conv").sortWithinPartitions("conv", "place", "step")
    return _rows(rows, _digest, "conv string, audit string, repaired_sha256 string")


def audit(df: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of ``df`` (``conv_id``; also those of which nothing is left in ``damaged``):
    faults, cheapest cost, edits and digest of the repair of ``damaged``."""
    fixed = repair(damaged)
    turns, script = fixed.turns, fixed.script
    per = turns.groupBy("conv").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.max("turn").alias("hi"), F.min("turn").alias("lo"))
    numbers = turns.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.count("one").alias("numbers"))
    conv = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv")
    every = df.select("conv_id").distinct().select("conv_id", conv)
    rows = every.join(per, "conv", "left").join(numbers, "conv", "left").join(digests(script), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("numbers"), F.lit(0)).cast("long").alias("gaps")
    return rows.select("conv_id", gaps, *[zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
