"""Conversation repair against a plain search over all edits, row by row."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tte.llm.conversation_repair import (GONE, IDENTITY, Costs, apply, before, damage, end_costs, power, repair_conversations,
                                         repair_digest, unroll)

COSTS = Costs()
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def search(symbols, costs=COSTS):
    """Cheapest edits of (initial, gone, truncated) rows: cost, audit and what each letter leads to."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    keep = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    memo = {}

    def best(i, state, inserted):
        if (i, state, inserted) in memo:
            return memo[i, state, inserted]
        found = []
        if i == len(symbols):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            initial, gone, cut = symbols[i]
            c, a, o = best(i + 1, state, 0)
            found.append((c + costs.delete, "D" + a, o))
            if not gone:
                if (state, initial) in keep:
                    c, a, o = best(i + 1, initial, 0)
                    found.append((c + costs.keep + cut * costs.truncated, "K" + a, ((i, None), *o)))
                c, a, o = best(i + 1, turn[state], 0)
                found.append((c + costs.rerole + cut * costs.truncated, "R" + a, ((i, turn[state]), *o)))
        if inserted < 3:
            c, a, o = best(i, turn[state], inserted + 1)
            found.append((c + costs.insert, "I" + a, ((None, turn[state]), *o)))
        memo[i, state, inserted] = min(found) if found else (10 ** 9, "", ())
        return memo[i, state, inserted]

    return best(0, "", 0)


def plain(rows, costs=COSTS):
    """rows of one conversation, (turn, role, text) without nulls but in turn, to its report and lines."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
    turns = {t for t, *_ in rows if t is not None}
    initials = [s[0] for s in symbols]
    cost, audit, out = search(symbols, costs)
    names = {"u": "user", "a": "assistant"}
    lines = [f"{names[to]}:" if i is None else f"{names[to] if to else rows[i][1]}:{rows[i][2]}" for i, to in out]
    return dict(counts, gaps=max(turns) - min(turns) + 1 - len(turns) if turns else 0, cost=cost, audit=audit,
                illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), lines=lines,
                repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(conversations):
    out = {}
    for conv, turn, role, text in conversations:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def check_digest(spark, rows):
    got = {r.conv_id: r.asDict() for r in repair_digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    want = damaged(rows)
    assert got.keys() == want.keys()
    for conv, kept in want.items():
        expected = plain(kept)
        expected.pop("lines")
        got[conv].pop("conv_id")
        assert got[conv] == expected, (conv, kept)


def test_powers_are_repeated_steps():
    rng = random.Random(1)
    for _ in range(60):
        symbol, length = rng.randrange(9), rng.randrange(1, 40)
        after = end_costs(COSTS)
        for _ in range(rng.randrange(5)):
            after = apply(power(rng.randrange(9), 0, COSTS), after)
        slow = after
        for _ in range(length):
            slow = apply(power(symbol, 0, COSTS), slow)
        assert before(symbol, length, after, COSTS) == slow
        plan, _ = unroll(symbol, length, after, 0, COSTS)
        assert len(re.sub("[ua]", "", plan)) == length
    assert apply(IDENTITY, (3, 1, 4, 1)) == (3, 1, 4, 1)
    assert apply(power(GONE, 0, COSTS), end_costs(COSTS))[0] == 2


@pytest.mark.parametrize("costs", [COSTS, Costs(insert=1, delete=3), Costs(insert=1, delete=1, rerole=1, truncated=1), Costs(rerole=4, insert=2)])
def test_cheapest_and_least_audits(spark, costs):
    rng = random.Random(7)
    texts = ["Fine.", "cut off", " ", "", "Why?", "same.", "no end,  \n", "é!"]
    rows = [(c, rng.choice([None, *range(8)]) if c % 3 else t, rng.choice(["user", "assistant", "system", "tool", "", "user"]), rng.choice(texts))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    done = repair_conversations(df, costs=costs)
    report = {r.conv_id: r for r in done.report.collect()}
    kept = {}
    for r in done.rows.orderBy("conv_id", "segment", "place", "step").collect():
        kept.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c in report:
        want = plain([r[1:] for r in rows if r[0] == c], costs)
        assert (report[c].cost, report[c].audit, kept.get(c, [])) == (want["cost"], want["audit"], want["lines"]), c


def test_segments_do_not_change_the_result(spark):
    rng = random.Random(3)
    rows = [(c, t // 2, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Text {t}.", f"cut {t}", "Again.", ""]))
            for c in (1, 2) for t in range(300)] + [(2, 7, "user", "Again.")] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    small, large = (repair_conversations(df, segment=n) for n in (7, 10_000))
    for part in ("cost", "audit", "illegal", "duplicate"):
        assert {r.conv_id: r[part] for r in small.report.collect()} == {r.conv_id: r[part] for r in large.report.collect()}
    lines = [[(r.conv_id, r.role, r.text) for r in x.rows.orderBy("conv_id", "segment", "place", "step").collect()] for x in (small, large)]
    assert lines[0] == lines[1]
    for c in (1, 2):
        want = plain([r[1:] for r in rows if r[0] == c])
        got = small.report.where(F.col("conv_id") == c).first()
        assert (got.cost, got.audit, got.illegal) == (want["cost"], want["audit"], want["illegal"])


def test_digest_of_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "A question?"), (1, None, "user", "x" * 200_000 + "."), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
            (2, 5, "", "No role."), (3, 0, "user", None), (4, 9, "system", "Only a system row."), (5, 1, "Uncle", "Capital."), (6, 3, "user", "漢字。"),
            (7, -4, "user", "Before zero."), (7, 8, "assistant", " ")]
    rows += [(100 + c, t, ("user", "assistant")[t % 2], f"Row {t} of {c}.") for c in range(80) for t in range(c % 6 + 1)]
    rows += [(300, t, "user" if t % 2 else "assistant", "Said again.") for t in range(30)]
    check_digest(spark, rows)


def test_whole_table_by_plain_search(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    check_digest(spark, [tuple(r) for r in table.collect()])


def test_empty_table_clashing_columns_and_damage(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_digest(empty).count() == 0
    done = repair_conversations(empty)
    assert done.report.count() == 0 and done.rows.count() == 0
    wide = spark.createDataFrame([(1, t, ("user", "assistant")[t % 2], f"Line {t}.", "x", "y", 3) for t in range(4)],
                                 SCHEMA + ", ck string, rid string, seg int")
    assert repair_conversations(wide).report.first().audit == "KKKK"
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = repair_digest(spark.createDataFrame([(gone, 0, "user", "Dropped.")], SCHEMA)).first()
    assert (one.cost, one.audit, one.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    assert damage(spark.createDataFrame([(gone, 0, "user", "Dropped.")], SCHEMA)).count() == 0
