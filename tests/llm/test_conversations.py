"""Conversation repair: matrices and grammar against a search over all edits, whole results
against a plain version, defined results."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from slotwise.llm import conversations as conv
from slotwise.llm.common import prepare

TABLE = "conv_id long, turn long, role string, text string, conv string, pos string, n string, audit string, letter string"
GOOD = re.compile(r"(s?(ua)+)?")


def conversations(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "c", "p", "n", "a", "l") for r in rows], TABLE)


# ------------------------------------------------------------------ plain version
def least_edits(letters: str):
    """(cost, audit): all cheapest audits of every state are kept, row by row (of more than
    14 rows the least one of each state)."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def insert(states):
        queue = list(states.items())
        while queue:
            state, (cost, audits) = queue.pop(0)
            for to in "ua":
                if to in moves[state]:
                    new = (cost + conv.INSERT, {a + "I" for a in audits})
                    old = states.get(to)
                    if old is None or new[0] < old[0] or new[0] == old[0] and new[1] - old[1]:
                        states[to] = new if old is None or new[0] < old[0] else (new[0], new[1] | old[1])
                        queue.append((to, states[to]))
        return states

    states = insert({"": (0, {""})})
    for x in letters:
        after: dict = {}

        def add(state, cost, audits):
            old = after.get(state)
            if old is None or cost < old[0]:
                after[state] = (cost, set(audits))
            elif cost == old[0]:
                after[state] = (cost, old[1] | set(audits))
        for state, (cost, audits) in states.items():
            add(state, cost + conv.DELETE, {a + "D" for a in audits})
            if x == "x":
                continue
            extra = conv.CUT_SHORT if x.isupper() else 0
            if x.lower() in moves[state]:
                add(x.lower(), cost + extra, {a + "K" for a in audits})
            for to in "ua":
                if to in moves[state]:
                    add(to, cost + conv.REROLE + extra, {a + "R" for a in audits})
        states = insert(after)
        if len(letters) > 14:
            states = {s: (cost, {min(audits)}) for s, (cost, audits) in states.items()}
    ends = [states[s] for s in ("", "a") if s in states]
    cost = min(c for c, _ in ends)
    return cost, min(a for c, audits in ends if c == cost for a in audits)


def plain_report(rows, damaged=True):
    kept: dict = {r[0]: [] for r in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damaged else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, rs in kept.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, letters, faults = set(), "", []
        for _, role, text in rs:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            ini = role[:1] if role[:1] in ("s", "u", "a") and role else "o"
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            letters += "x" if fault in ("blank", "duplicate") else ini.upper() if fault else ini
        cost, audit = least_edits(letters)
        lines, state, it = [], "", iter(rs)
        for e in audit:
            row = None if e == "I" else next(it)
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{'' if e == 'I' else row[2]}")
        assert GOOD.fullmatch("".join(x[0] for x in lines))
        turns = [t for t, *_ in rs if t is not None]
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                  *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                  sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:])),
                  cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(report):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in report.collect()}


# ------------------------------------------------------------------ matrices
def test_matrices_and_ropes_equal_the_search(monkeypatch):
    monkeypatch.setattr(conv, "FLAT", 3)
    rng = random.Random(3)
    for _ in range(400):
        letters = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 14)))
        grammar = conv.Grammar([])
        assert grammar.whole(letters) == least_edits(letters)
        if letters:
            assert conv.finish(grammar.product(letters)[0]) == least_edits(letters)


def test_rules_share_matrices_and_change_nothing():
    rules = [("Ā", "u", "a"), ("ā", "Ā", "Ā"), ("Ă", "x", "ā"), ("ă", "Ă", "U")]
    grammar = conv.Grammar(rules)
    assert grammar.whole("ăsĂo") == least_edits("xuauaUsxuauao")
    long = conv.Grammar([("Ā", "o", "a"), *[(chr(0x100 + i), chr(0xFF + i), chr(0xFF + i)) for i in range(1, 17)]])
    cost, audit = long.whole("Đ")                       # 2^17 rows through 17 rules
    assert (cost, audit) == (3 << 16, "RK" * (1 << 16))


def test_ropes_compare_as_texts():
    rng = random.Random(1)
    for _ in range(300):
        parts = ["".join(rng.choice("DI") for _ in range(rng.randint(1, 4))) for _ in range(6)]
        a = conv.Rope(conv.Rope(parts[0], parts[1]), conv.Rope(parts[2], parts[3]))
        b = conv.Rope(parts[0], conv.Rope(conv.Rope(parts[1], parts[4]), parts[5]))
        assert conv.less(a, b) == (conv.text_of(a) < conv.text_of(b))
        assert conv.less(b, a) == (conv.text_of(b) < conv.text_of(a)) and not conv.less(a, a)


# ------------------------------------------------------------------ whole results
def messy(seed: int, n: int):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Ends. \n", "É?", "Why? Because", "same", "Long " * 2_000 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "u", "sys"]
    rows = []
    for c in [None, *range(n)]:
        for t in range(rng.randint(1, 11)):
            rows.append((c, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts)))
    return rows


def test_report_equals_the_plain_version(spark):
    rows = messy(11, 120)
    table = conversations(spark, rows)
    got = result(conv.repair_report(table, conv.damage(table)))
    assert got == plain_report(rows)
    # rows (7, 3) and (7, 9) and so on may all be dropped: such conversations stay
    assert set(got) == {r[0] for r in rows}


def test_long_conversations_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(conv, "CHUNK_BITS", 2)
    monkeypatch.setattr(conv, "FAN_IN", 2)
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "x"]), rng.choice(["a.", f"b{t}.", f"c{t}", ""]))
            for c, n in ((1, 700), (2, 90), (3, 1), (None, 40)) for t in range(n)]
    table = conversations(spark, rows)
    assert result(conv.repair_report(table, conv.damage(table))) == plain_report(rows)


def test_repaired_rows_are_the_ones_digested(spark):
    rows = messy(5, 40)
    table = conv.as_rows(conversations(spark, rows))
    plan = conv.repair_plan(table)
    wanted = plain_report(rows, damaged=False)
    by_conv: dict = {}
    for r in conv.repaired_rows(table, plan).orderBy("conv", "place").collect():
        by_conv.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for c, w in wanted.items():
        assert hashlib.sha256("\n".join(by_conv.get(c, [])).encode()).hexdigest() == w[-1]


def test_empty_table_and_dropped_rows(spark):
    none = conversations(spark, [])
    assert conv.repair_report(none, conv.damage(none)).count() == 0
    lost = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = conversations(spark, [(lost, 0, "user", "Hello.")])
    assert result(conv.repair_report(table, conv.damage(table))) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_many_equal_conversations_share_their_work(spark):
    table = conversations(spark, []).unionByName(spark.range(3_000).select(
        F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("turn"))
        .withColumn("role", F.expr("element_at(array('system', 'assistant', 'user'), int(turn) + 1)")).withColumn("text", F.lit("Hi.")),
        allowMissingColumns=True)
    plan = conv.repair_plan(conv.as_rows(table))
    assert [tuple(r) for r in plan.select("cost", "audit").distinct().collect()] == [least_edits("sau")]


@pytest.mark.parametrize("column", ["conv_id", "turn"])
def test_null_columns(spark, column):
    rows = [(1, 2, "user", "Hi."), (1, 3, "assistant", "Ho."), (2, 5, "user", "cut")]
    rows = [tuple(None if c == column else v for c, v in zip(("conv_id", "turn", "role", "text"), r)) for r in rows]
    table = conversations(spark, rows)
    assert result(conv.repair_report(table, conv.damage(table))) == plain_report(rows)
