"""Repair of conversations: cells, audits, and the repaired turns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from textquarry.llm import conversation_repair as repair

LANGUAGE = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(turns, most_inserts=4):
    """The least (cost, audit) over all edits of every turn and all insertions, tried one by one."""
    best = None
    choices = []
    for initial, fault in turns:
        own = [("D", 4, "")]
        if fault in ("fine", "truncated"):
            more = 3 if fault == "truncated" else 0
            own += [("K", more, initial), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        choices.append(own)
    inserts = [("", 0, "")]
    for k in range(1, 3):
        inserts += [("I" * k, 3 * k, "".join(r)) for r in itertools.product("ua", repeat=k)]
    gaps = len(turns) + 1
    for edits in itertools.product(*choices):
        for put in itertools.product(inserts, repeat=gaps):
            if sum(len(x[0]) for x in put) > most_inserts:
                continue
            roles = put[0][2] + "".join(e[2] + x[2] for e, x in zip(edits, put[1:]))
            if LANGUAGE.match(roles):
                cost = sum(x[1] for x in put) + sum(e[1] for e in edits)
                audit = put[0][0] + "".join(e[0] + x[0] for e, x in zip(edits, put[1:]))
                if best is None or (cost, audit) < best:
                    best = cost, audit
    return best


def whole_chart(turns):
    """Every span of turns, by length, over every place to cut it."""
    n = len(turns)
    chart = {(i, i + 1): repair.turn_cells(*t) for i, t in enumerate(turns)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            ways = [repair.joined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            chart[i, i + length] = repair._least([(at, c) for w in ways for at, c in enumerate(w) if c is not None])
    return repair.cheapest(chart[0, n] if n else repair.EMPTY)


def some_turns(rnd, n):
    return [(rnd.choice("sua?uaua"), rnd.choice(["fine"] * 6 + ["blank", "duplicate", "truncated"])) for _ in range(n)]


def test_cells_equal_trying_everything():
    rnd = random.Random(3)
    for n in (0, 1, 2, 2, 2, 3, 3, 3):
        turns = some_turns(rnd, n)
        assert repair.cheapest(repair.halved([repair.turn_cells(*t) for t in turns])) == exhaustive(turns), turns


def test_halving_equals_the_whole_chart():
    rnd = random.Random(4)
    for _ in range(60):
        turns = some_turns(rnd, rnd.randint(0, 14))
        assert repair.cheapest(repair.halved([repair.turn_cells(*t) for t in turns])) == whole_chart(turns)


ROWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("pos", "letter", "audit", "_c", "h1", "block")],
    ]
)


@pytest.fixture(scope="module")
def make_rows(spark):
    return lambda rows: spark.createDataFrame([(*r, *["x"] * 6) for r in rows], ROWS)


def by_loop(rows):
    """Reports and repaired turns of each conversation, from the rules."""
    out, groups = {}, collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            kept = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "fine" if kept[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        numbers = [t for t, *_ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        symbols = [(i if i and i in "sua" else "?", f) for i, f in zip(initials, faults)]
        cost, audit = whole_chart(symbols)
        state, at, lines = "", 0, []
        for edit in audit:
            flipped = "assistant" if state == "u" else "user"
            if edit == "I":
                role, text = flipped, ""
            else:
                _, role, text = turns[at]
                at += 1
                if edit == "D":
                    continue
                role = flipped if edit == "R" else role
            state = role[0]
            lines.append(f"{role}:{text}")
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def results(df, **sizes):
    audits = repair.audit_conversations(df, **sizes).cache()
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digest_conversations(repair.repair_conversations(df, audits)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r[0]: (*r[1:], digests.get(r[0], nothing)) for r in audits.collect()}


def some_rows(seed, conversations, turns):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why? \t", "é.", "same.", "same.", "x" * 500 + "."]
    return [
        (c, rnd.choice([None, *range(turns)]) if rnd.random() < 0.1 else t, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"{rnd.random()}.")
        for c in [None, *range(conversations)]
        for t in range(rnd.randint(1, turns))
    ]


def test_audits_of_odd_rows(make_rows):
    rows = some_rows(1, 30, 9)
    rows += rows[:5]  # repeated rows
    # Texts of one turn and role would follow their hashes here and themselves in the loop.
    first = {}
    rows = [r for r in rows if first.setdefault((r[0], r[1], r[2]), r[3]) == r[3]]
    assert results(make_rows(rows)) == by_loop(rows)
    assert results(make_rows([])) == {}


def test_long_conversations_are_built_from_spans(make_rows):
    rnd = random.Random(9)
    rows = [(7, t, ("user", "assistant")[t % 2] if rnd.random() < 0.8 else "user", f"{t % 60}{rnd.choice('.!?x')}") for t in range(120)]
    rows += [(8, 0, "user", "only."), (9, 5, "assistant", "")]
    want = by_loop(rows)
    for sizes in ({}, {"span": 4, "fan": 2}, {"span": 7, "fan": 3}):
        assert results(make_rows(rows), **sizes) == want


def test_damage_follows_the_checksum(make_rows):
    rows = some_rows(2, 60, 6)
    want = collections.Counter()
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want[conv, turn, "user" if k == 4 else role, text] += {0: 0, 3: 2}.get(k, 1)
    assert collections.Counter(map(tuple, repair.damage(make_rows(rows)).collect())) == +want
