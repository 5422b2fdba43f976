"""Conversation repair against a search over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tributary.llm import repair

GOOD = re.compile(r"(s?(ua)+)?")
OTHER_SPACE = re.compile(r"[^\x20\x09-\x0D]")


def fault_list(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = OTHER_SPACE.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired rows): a table over (row, initials so far reduced to the last), whole strings kept."""
    faults, n = fault_list(rows), len(rows)
    best = {(0, ""): (0, "", ())}  # (rows used, shape) -> cost, audit, output; shape: '', s, u or a
    fresh = [(0, "")]
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    while fresh:
        at, shape = fresh.pop(0)
        cost, audit, out = best[at, shape]
        steps = [(2, "I", at, x, ((names[x], ""),)) for x in follow[shape] if x in names]
        if at < n:
            role, text = rows[at]
            steps.append((3, "D", at + 1, shape, ()))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                if role[:1] and role[:1] in follow[shape]:
                    steps.append((more, "K", at + 1, role[:1], ((role, text),)))
                steps += [(2 + more, "R", at + 1, x, ((names[x], text),)) for x in follow[shape] if x in names]
        for price, edit, to, x, new in steps:
            way = (cost + price, audit + edit, out + new)
            if (to, x) not in best or way[:2] < best[to, x][:2]:
                best[to, x] = way
                fresh.append((to, x))
    return min((best[n, x] for x in ("", "a") if (n, x) in best), key=lambda w: w[:2])


def expected(rows):
    """rows: (conv_id, turn, role, text) before the damage -> the contract's rows."""
    groups, out = defaultdict(list), {}
    said = lambda x: " " if x is None else x
    for conv_id, turn, role, text in rows:
        own = groups[conv_id]
        kind = zlib.crc32(f"{said(conv_id)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv_id, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns, said_rows = [t for t, _, _ in own if t is not None], [r[1:] for r in own]
        faults = fault_list(said_rows)
        cost, audit, fixed = brute(said_rows)
        initials = [r[0][:1] for r in said_rows]
        assert GOOD.fullmatch("".join(r[:1] for r, _ in fixed))
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def conversations():
    r = random.Random(4)
    texts = ["Yes.", "no", "Why?", "", " \t", "a\nb!", "end. \n", " ", "中。", "¿", "Yes.", "x" * 5000 + "."]
    rows = []
    for conv in range(250):
        for turn in range(r.choice([0, 1, 2, 3, 5, 8, 9])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "ux"])
            rows.append((conv, None if r.random() < .03 else turn + (r.random() < .1), role, r.choice([*texts, None, f"t{turn}."])))
    rows += [(None, 0, "user", "lost."), (None, 1, "assistant", "id?"), (None, None, None, None), (-3, 10**12, "user", "q."), (-3, -5, "assistant", "a.")]
    rows += rows[:12]  # repeated rows
    return rows


def test_cheapest_equals_brute_force_on_every_short_conversation():
    kinds = [(role, fault) for role in ("system", "user", "assistant", "tool") for fault in range(4)]
    r = random.Random(8)
    cases = [list(c) for n in range(4) for c in itertools.product(kinds, repeat=n)] + [[r.choice(kinds) for _ in range(n)] for n in (5, 9, 17, 40) for _ in range(60)]
    for case in r.sample(cases, 1500) + cases[:300]:
        rows, seen = [], []
        for k, (role, fault) in enumerate(case):
            if fault == repair.DUPLICATE and not any(x == role for x, _ in seen):
                fault = repair.SOUND
            text = {repair.SOUND: f"{k}.", repair.BLANK: "", repair.CUT_SHORT: f"{k}", repair.DUPLICATE: next((t for x, t in seen if x == role), "")}[fault]
            rows.append((role, text))
            if fault in (repair.SOUND, repair.CUT_SHORT):
                seen.append((role, text))
        names = {"": repair.SOUND, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.CUT_SHORT}
        codes = bytes(repair.code(role[:1], names[f]) for (role, _), f in zip(rows, fault_list(rows)))
        assert repair.cheapest(codes) == brute(rows)[:2]


def test_digests_equal_brute_force(spark):
    rows = conversations()
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, code string").repartition(4)
    got = repair.repair_digests(repair.damage(table)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})


def test_whole_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = repair.repair_digests(repair.damage(table)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = [r for r in conversations() if r[0] is None or r[0] < 60]
    table = repair.damage(spark.createDataFrame(rows, "conv_id int, turn long, role string, text string"))
    edits = defaultdict(list)
    for r in repair.repair(table).collect():
        edits[r.conv_id].append((r.place, r.edit, r.role, r.text))
    for conv_id, want in expected(rows).items():
        own = sorted(edits[conv_id])
        assert "".join(e for _, e, _, _ in own) == want[6]
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, e, role, text in own if e != "D").encode()).hexdigest() == want[7]


def test_a_very_long_conversation_and_an_empty_table(spark):
    long = spark.range(3000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0 or id % 7 = 0, 'user', 'assistant') as role",
                                        "concat('line ', id, if(id % 5 = 0, '', '.')) as text")
    got = repair.repair_digests(long).collect()
    rows = [(r.role, r.text) for r in long.orderBy("turn").collect()]
    cost, audit, _ = brute(rows)
    assert [(r.cost, r.audit, r.gaps) for r in got] == [(cost, audit, 0)]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_digests(repair.damage(none)).collect() == [] and repair.repair(none).collect() == []


@pytest.mark.parametrize("text, state", [("", repair.BLANK), (" ", repair.CUT_SHORT), ("ok.\x0b", repair.SOUND)])
def test_white_space_is_that_of_ascii(spark, text, state):
    row = spark.createDataFrame([(1, 0, "user", text)], "conv_id long, turn long, role string, text string")
    out = repair.repair_digests(row).first()
    assert (out.blank, out.duplicate, out.truncated) == (state == repair.BLANK, 0, state == repair.CUT_SHORT)
