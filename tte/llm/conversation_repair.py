"""Repair of conversation structure by a run-length dynamic program.

A conversation's rows, in order, become symbols: what the role begins with, and the row's fault. The
cheapest edits that turn the rows into ``(system? (user assistant)+)?`` are a shortest path over four
states (nothing yet, after system, after user, after assistant); one symbol is a 4 x 4 min-plus matrix.
Equal consecutive symbols collapse into runs, and a run of length L advances the costs by the cached
binary powers of its matrix, in log L steps. The choices of a run are then unrolled by halves, each half
with the costs behind it from the same powers, and remembered by (symbol, length, costs, state).

No conversation has to fit into a task. Rows are ranged by (conversation, order), so a long conversation
lies in many tasks; each task cuts its range into segments and multiplies the segment's matrix. Costs
run backwards over the few segments of a conversation, every segment is unrolled alone for the states
it may be entered in, and the states run forwards. Texts do not take part: they are compared by digest,
and only the rows that stay are joined with their texts at the end.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.llm.common import written

#: Rows of a conversation that one segment holds at most.
SEGMENT = 16_384
#: Segments in one Arrow batch of their table.
SEGMENT_BATCH = 512
BLANKS = " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where a kept row of each initial leads from each state, and where a user or assistant row leads.
_KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {}}
_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KINDS = ("s", "u", "a", "")
#: The symbol of a row that has to go; other symbols are ``2 * kind + truncated``.
GONE = 8
#: Codes of the edits in a plan: to delete, keep, make it user or assistant, insert user or assistant.
DELETE, KEEP, TO_USER, TO_ASSISTANT, NEW_USER, NEW_ASSISTANT = "DKUAua"
#: The plan's codes as the audit's initials: Delete, Insert, Keep, Rerole.
_AUDIT = str.maketrans({TO_USER: "R", TO_ASSISTANT: "R", NEW_USER: "I", NEW_ASSISTANT: "I"})
_INF = 1 << 60


class Costs(NamedTuple):
    """Costs of the edits; an undeleted truncated row costs ``truncated`` more. All whole numbers, insert
    positive."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Repair(NamedTuple):
    """``report``: one row per conversation. ``rows``: the repaired conversations' rows."""

    report: DataFrame
    rows: DataFrame


Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def apply(m: Matrix, v: Vector) -> Vector:
    """Costs before what ``m`` stands for, from the costs behind it."""
    return tuple(min(m[s][t] + v[t] for t in STATES) for s in STATES)


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[s][k] + b[k][t] for k in STATES), _INF) for t in STATES) for s in STATES)


IDENTITY: Matrix = tuple(tuple(0 if s == t else _INF for t in STATES) for s in STATES)


@lru_cache(maxsize=64)
def inserts(costs: Costs) -> Matrix:
    """Cheapest insertions from state to state."""
    step = tuple(tuple(0 if s == t else costs.insert if _TURN[s] == t else _INF for t in STATES) for s in STATES)
    return multiply(step, multiply(step, step))


@lru_cache(maxsize=64)
def end_costs(costs: Costs) -> Vector:
    """Costs at the end: a conversation ends with nothing or after an assistant row."""
    return apply(inserts(costs), (0, _INF, _INF, 0))


def edits(symbol: int, state: int, costs: Costs) -> list[tuple[str, int, int]]:
    """(code, cost, next state) of what can be done with a row, in the order of the audit's initials."""
    out = [(DELETE, costs.delete, state)]
    if symbol != GONE:
        more = costs.truncated * (symbol & 1)
        kept = _KEEP[_KINDS[symbol >> 1]].get(state)
        if kept is not None:
            out.append((KEEP, costs.keep + more, kept))
        turn = _TURN[state]
        out.append((TO_USER if turn == USER else TO_ASSISTANT, costs.rerole + more, turn))
    return out


@lru_cache(maxsize=4096)
def power(symbol: int, j: int, costs: Costs) -> Matrix:
    """The symbol's matrix to the power of ``2 ** j``."""
    if j:
        half = power(symbol, j - 1, costs)
        return multiply(half, half)
    row = [[_INF] * 4 for _ in STATES]
    for s in STATES:
        for _, cost, t in edits(symbol, s, costs):
            row[s][t] = min(row[s][t], cost)
    return multiply(inserts(costs), tuple(map(tuple, row)))


def before(symbol: int, length: int, after: Vector, costs: Costs) -> Vector:
    """Costs before a run from the costs behind it."""
    for j in range(length.bit_length()):
        if length >> j & 1:
            after = apply(power(symbol, j, costs), after)
    return after


@lru_cache(maxsize=200_000)
def _unrolled(symbol: int, length: int, after: Vector, state: int, costs: Costs) -> tuple[str, int]:
    if length > 1:
        half = length // 2
        one, state = unroll(symbol, length - half, before(symbol, half, after, costs), state, costs)
        two, state = unroll(symbol, half, after, state, costs)
        return one + two, state
    ahead, plan = before(symbol, 1, after, costs), ""
    while True:
        # of equally cheap edits the least initial: Delete, Insert, Keep, Rerole
        options = edits(symbol, state, costs)
        turn = _TURN[state]
        options.insert(1, (NEW_USER if turn == USER else NEW_ASSISTANT, costs.insert, None))
        for code, cost, to in options:
            if cost + (ahead[turn] if to is None else after[to]) == ahead[state]:
                plan += code
                break
        if to is not None:
            return plan, to
        state = turn


def unroll(symbol: int, length: int, after: Vector, state: int, costs: Costs) -> tuple[str, int]:
    """The choices for a run entered in ``state``, and the state behind it. Only differences of costs
    matter, so equal ones are looked up."""
    least = min(after)
    return _unrolled(symbol, length, tuple(x - least for x in after), state, costs)


def closing(state: int, costs: Costs) -> str:
    """Insertions behind the last row."""
    plan = ""
    while end_costs(costs)[state]:
        state = _TURN[state]
        plan += NEW_USER if state == USER else NEW_ASSISTANT
    return plan


def runs_of(symbols: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """Collapsed (symbol, length); a row that occurs several times is followed by rows that have to go."""
    out: list[list[int]] = []
    for symbol, n in zip(symbols, counts, strict=True):
        for x, m in ((symbol, 1), (GONE, n - 1)):
            if m and out and out[-1][0] == x:
                out[-1][1] += m
            elif m:
                out.append([x, m])
    return [(x, m) for x, m in out]


def illegal_pair(one: int, two: int) -> bool:
    return (one, two) not in ((0, 1), (1, 2), (2, 1))


# -- tasks ------------------------------------------------------------------------------------------

_SEGMENT = pa.schema([("ck", pa.string()), ("seg", pa.int64()), ("opens", pa.bool_()), ("rids", pa.list_(pa.string())),
                      ("syms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("matrix", pa.list_(pa.int64())),
                      ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
_SEGMENT_SQL = ("ck string, seg bigint, opens boolean, rids array<string>, syms array<int>, counts array<int>, matrix array<bigint>, "
                "illegal bigint, first int, last int")


def _emit(schema: pa.Schema, rows):
    """Record batches of at most ``SEGMENT_BATCH`` rows from an iterator of tuples."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == SEGMENT_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches, *names: str):
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _cut(costs: Costs, limit: int):
    """Rows in order (ck, rid, sym, kind, n) to segments."""

    def segments(batches):
        number, now = TaskContext.get().partitionId() << 40, None
        rids, syms, counts, kinds, size, opens = [], [], [], [], 0, False

        def segment():
            runs, matrix = runs_of(syms, counts), IDENTITY
            for symbol, length in runs:
                for j in range(length.bit_length()):
                    if length >> j & 1:
                        matrix = multiply(matrix, power(symbol, j, costs))
            illegal = sum(n - 1 for n in counts) + sum(map(illegal_pair, kinds, kinds[1:]))
            return (now, number, opens, list(rids), list(syms), list(counts), [x for row in matrix for x in row], illegal, kinds[0], kinds[-1])

        # the first conversation of a task may have begun in the task before
        for ck, rid, sym, kind, n in _rows(batches, "ck", "rid", "sym", "kind", "n"):
            while n:
                if size == limit or size and ck != now:
                    yield segment()
                    number, rids, syms, counts, kinds, size, opens = number + 1, [], [], [], [], 0, ck != now
                now, part = ck, min(n, limit - size)
                rids.append(rid), syms.append(sym), counts.append(part), kinds.append(kind)
                # what is left of a row cut in two repeats it
                size, n, sym, rid = size + part, n - part, GONE, None
        if size:
            yield segment()

    return lambda batches: _emit(_SEGMENT, segments(batches))


_BACK = pa.schema([("ck", pa.string()), ("seg", pa.int64()), ("after", pa.list_(pa.int64()))])


def _backward(costs: Costs):
    """Segments in descending order (ck, seg, matrix) to the costs behind each."""

    def behind(batches):
        now, cost = None, None
        for ck, seg, matrix in _rows(batches, "ck", "seg", "matrix"):
            if ck != now:
                now, cost = ck, end_costs(costs)
            yield ck, seg, cost
            cost = apply(tuple(tuple(matrix[4 * s: 4 * s + 4]) for s in STATES), cost)

    return lambda batches: _emit(_BACK, behind(batches))


_PLANS = pa.schema([("ck", pa.string()), ("seg", pa.int64()), ("rids", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
                    ("plans", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())), ("cost", pa.int64()), ("illegal", pa.int64()),
                    ("first", pa.int32()), ("last", pa.int32())])
_PLANS_SQL = ("ck string, seg bigint, rids array<string>, counts array<int>, plans array<string>, ends array<int>, cost bigint, "
              "illegal bigint, first int, last int")


def _plan(costs: Costs):
    """Segments with the costs behind them to the plan and last state for each state they may begin in."""

    def plans(batches):
        for ck, seg, opens, rids, syms, counts, after, illegal, first, last in _rows(
                batches, "ck", "seg", "opens", "rids", "syms", "counts", "after", "illegal", "first", "last"):
            runs, behind = runs_of(syms, counts), [tuple(after)]
            for symbol, length in reversed(runs):
                behind.append(before(symbol, length, behind[-1], costs))
            behind.reverse()
            chosen, ends = [], []
            for state in (START,) if opens else STATES:
                parts = []
                for (symbol, length), cost in zip(runs, behind[1:], strict=True):
                    part, state = unroll(symbol, length, cost, state, costs)
                    parts.append(part)
                chosen.append("".join(parts))
                ends.append(state)
            yield ck, seg, rids, counts, chosen, ends, behind[0][START], illegal, first, last

    return lambda batches: _emit(_PLANS, plans(batches))


_FORWARD = pa.schema([("ck", pa.string()), ("seg", pa.int64()), ("entry", pa.int32()), ("closing", pa.string()), ("cost", pa.int64()),
                      ("illegal", pa.int64())])


def _forward(costs: Costs):
    """Segments in order (ck, seg, ends, cost, illegal, first, last) to the state each begins in."""

    def states(batches):
        held = None  # the segment before, not yet known to be its conversation's last
        for ck, seg, ends, cost, illegal, first, last in _rows(batches, "ck", "seg", "ends", "cost", "illegal", "first", "last"):
            if held and held[0][0] == ck:
                yield held[0][0], held[0][1], held[0][2], "", held[0][3], held[0][4]
                state, cost, illegal = held[1], 0, illegal + illegal_pair(held[2], first)
            else:
                if held:
                    yield held[0][0], held[0][1], held[0][2], closing(held[1], costs), held[0][3], held[0][4]
                state = START
            held = (ck, seg, state, cost, illegal), ends[state], last
        if held:
            yield held[0][0], held[0][1], held[0][2], closing(held[1], costs), held[0][3], held[0][4]

    return lambda batches: _emit(_FORWARD, states(batches))


_OUT = pa.schema([("ck", pa.string()), ("segment", pa.int64()), ("place", pa.int64()), ("step", pa.int32()), ("rid", pa.string()),
                  ("code", pa.string())])


def _outputs(batches):
    """Plans to the rows that stand in the repaired conversation."""

    def rows():
        for ck, seg, rids, counts, plan in _rows(batches, "ck", "seg", "rids", "counts", "plan"):
            heads, at = {}, 0
            for rid, n in zip(rids, counts, strict=True):
                heads[at] = rid
                at += n
            place = step = 0
            for code in plan:
                if code != DELETE:
                    yield ck, seg, place, step, None if code in (NEW_USER, NEW_ASSISTANT) else heads[place], code
                if code in (NEW_USER, NEW_ASSISTANT):
                    step += 1
                else:
                    place, step = place + 1, 0

    return _emit(_OUT, rows())


# -- the operator -----------------------------------------------------------------------------------


def _key(c: Column) -> Column:
    """A text without nulls that tells all values and null apart."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def repair_conversations(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         costs: Costs = Costs(), segment: int = SEGMENT) -> Repair:
    """Faults of all conversations and the cheapest edits that repair their structure.

    Rows stand in order of ``turn`` (nulls first); rows of one turn in order of role, then of the text's
    MD5 digest. A null role or text counts as one space, a null ``conv`` is a conversation like any other.
    A row's first fault counts: blank (no character but ASCII white space), duplicate (role and text
    stood earlier in the conversation; of equal rows all but one), truncated (the last character but white
    space is not one of ``.!?``). Blank and duplicate rows have to be deleted. Roles are told apart by
    their first character: s, u, a; a row with another one can be given a role or deleted.

    ``report``: ``conv, n_rows, gaps`` (missing whole numbers between the least and largest turn), ``blank,
    duplicate, truncated, illegal`` (adjacent rows whose roles do not follow each other), ``cost`` and
    ``audit``, the edits' initials (Delete, Insert, Keep, Rerole) in order; of equally cheap edits
    those whose audit is least. ``rows``: ``conv, segment, place, step`` (their order), ``role, text``
    and ``edit`` (K, R or I) of every row of the repaired conversations; inserted rows have an empty text.

    Every conversation with a row is in the report; an empty table gives empty results. Very long texts
    are joined to the result, not held in Python. Only the four named columns are read, so further columns
    do not matter."""
    words = F.coalesce(F.col(text), F.lit(" "))
    rows = conversations.select(_key(F.col(conv)).alias("ck"), F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                                F.coalesce(F.col(role), F.lit(" ")).alias("role"), words.alias("text"), F.md5(words.cast("binary")).alias("digest"))
    rows = rows.withColumn("rid", F.md5(F.to_json(F.struct("ck", "turn", "role", "digest"), {"ignoreNullFields": "false"}).cast("binary")))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    # equal rows meet before anything is moved, so one row that is repeated without end is one row
    distinct = (rows.select("ck", "turn", "role", "digest", "rid", fault.alias("fault"))
                .groupBy("ck", "turn", "role", "digest", "rid", "fault").agg(F.count(F.lit(1)).alias("n")))
    distinct = written(distinct, "repair-rows")
    first = distinct.where("fault < 2").groupBy("ck", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("f"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    judged = (distinct.join(first, ["ck", "role", "digest"], "left")
              .withColumn("again", (F.col("fault") < 2) & ~F.col("turn").eqNullSafe(F.col("f.turn")))
              .withColumn("kind", kind)
              .withColumn("sym", F.when((F.col("fault") == 2) | F.col("again"), GONE).otherwise(2 * F.col("kind") + F.col("fault"))))
    judged = written(judged.select("ck", "turn", "role", "digest", "rid", "fault", "again", "kind", "sym", "n"), "repair-judged")

    counts = (judged.groupBy("ck", "turn").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("fault") == 2, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == 2, 0).otherwise(F.col("n") - F.when(F.col("again"), 0).otherwise(1))).alias("duplicate"),
        F.sum(F.when((F.col("fault") == 1) & ~F.col("again"), 1).otherwise(0)).alias("truncated"))
        .groupBy("ck").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated"))))

    order = ["ck", F.col("turn").asc_nulls_first(), "role", "digest"]
    # rows left over where one is cut in two become segments of their own, so nothing depends on a partition's size
    segs = written(judged.select("ck", "turn", "role", "digest", "rid", "sym", "kind", "n").repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_cut(costs, segment), _SEGMENT_SQL), "repair-segments")
    back = (segs.select("ck", "seg", "matrix").repartition("ck").sortWithinPartitions("ck", F.desc("seg"))
            .mapInArrow(_backward(costs), "ck string, seg bigint, after array<bigint>"))
    plans = written(segs.drop("matrix").join(back, ["ck", "seg"]).mapInArrow(_plan(costs), _PLANS_SQL), "repair-plans")
    states = (plans.select("ck", "seg", "ends", "cost", "illegal", "first", "last").repartition("ck").sortWithinPartitions("ck", "seg")
              .mapInArrow(_forward(costs), "ck string, seg bigint, entry int, closing string, cost bigint, illegal bigint"))
    chosen = written(plans.select("ck", "seg", "rids", "counts", "plans").join(states, ["ck", "seg"])
                     .select("ck", "seg", "rids", "counts", F.concat(F.element_at("plans", F.col("entry") + 1), "closing").alias("plan"), "cost", "illegal"),
                     "repair-chosen")

    audit = F.translate(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "plan"))), lambda x: x["plan"]), ""), "UAua", "RRII")
    ends = chosen.groupBy("ck").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    names = rows.groupBy("ck").agg(F.first("conv").alias("conv"))
    report = names.join(counts, "ck").join(ends, "ck").select(
        F.col("conv").alias(conv), "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    out = chosen.mapInArrow(_outputs, "ck string, segment bigint, place bigint, step int, rid string, code string")
    out = written(out, "repair-out")
    texts = rows.groupBy("rid").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    own = out.where("rid is not null").join(texts, "rid").select(
        "ck", "segment", "place", "step", "code", "text",
        F.when(F.col("code") == TO_USER, "user").when(F.col("code") == TO_ASSISTANT, "assistant").otherwise(F.col("role")).alias("role"))
    new = out.where("rid is null").select("ck", "segment", "place", "step", "code", F.lit("").alias("text"),
                                          F.when(F.col("code") == NEW_USER, "user").otherwise("assistant").alias("role"))
    kept = own.unionByName(new)
    value = F.when(F.col("ck") == "", None).otherwise(F.substr("ck", F.lit(2))).cast(conversations.schema[conv].dataType)
    return Repair(report, kept.select(value.alias(conv), "segment", "place", "step", "role", "text",
                                      F.translate("code", "UAua", "RRII").alias("edit")))


_HASH = pa.schema([("ck", pa.string()), ("repaired_sha256", pa.string())])


def _hashes(batches):
    """Rows in order (ck, line) to the SHA-256 of each conversation's lines, joined by a newline."""

    def rows():
        now = digest = None
        for ck, line in _rows(batches, "ck", "line"):
            if ck != now:
                if digest:
                    yield now, digest.hexdigest()
                now, digest = ck, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode())
        if digest:
            yield now, digest.hexdigest()

    return _emit(_HASH, rows())


def repaired_hashes(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``ck, repaired_sha256`` of ``Repair.rows``; ``ck`` is ``conversation_key(conv)``. A hash over a whole conversation takes its rows one after
    the other: they stream through one task, which holds one batch of them."""
    lines = rows.select(_key(F.col(conv)).alias("ck"), "segment", "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    return (lines.repartition("ck").sortWithinPartitions("ck", "segment", "place", "step")
            .mapInArrow(_hashes, "ck string, repaired_sha256 string"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) modulo 20 (nulls: one space): 0 drops the row, 1 empties its
    text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it a user's; the others stay."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce(F.col("text"), blank)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("h")).where("h <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.coalesce(F.col("role"), blank)).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_digest(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Every conversation of ``conversations`` after ``damage``: its faults, the cost and audit of its repair
    and the hash of the repaired rows. A conversation of which no row is left has zeros, an empty audit
    and the empty text's hash."""
    done = repair_conversations(damage(conversations), costs=costs)
    hashes = repaired_hashes(done.rows)
    base = conversations.select("conv_id", _key(F.col("conv_id")).alias("ck")).groupBy("ck").agg(F.first("conv_id").alias("conv_id"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = done.report.withColumn("ck", _key(F.col("conv_id"))).drop("conv_id")
    return (base.join(found, "ck", "left").join(hashes, "ck", "left")
            .select("conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
