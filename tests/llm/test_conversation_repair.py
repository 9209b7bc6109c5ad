import hashlib
import random
import re
import zlib

import pytest

from obslake.llm import conversation_repair as cr

GRAMMAR = re.compile(r"(s?(ua)+)?")


def exhaustive(initials, fault, inserts=2):
    """Every edit sequence with up to ``inserts`` insertions: (least cost, least audit)."""
    best = []

    def go(i, out, audit, cost, left):
        if i == len(initials):
            if GRAMMAR.fullmatch("".join(out)):
                best.append((cost, audit))
        else:
            go(i + 1, out, audit + "D", cost + 2, left)
            if fault[i] not in ("blank", "duplicate"):
                extra = 5 if fault[i] == "truncated" else 0
                go(i + 1, out + [initials[i]], audit + "K", cost + extra, left)
                for r in "ua":
                    if r != initials[i]:
                        go(i + 1, out + [r], audit + "R", cost + 1 + extra, left)
        if left:
            for r in "ua":
                go(i, out + [r], audit + "I", cost + 5, left - 1)

    go(0, [], "", 0, inserts)
    return min(best)


def layered(initials, fault):
    """Backward dynamic programme over rows and states, with the least (cost, audit, turns) of each node."""
    n = len(initials)
    after = {q: ((0, "", ()) if q in cr.ACCEPT else None) for q in range(4)}

    def better(a, b):
        return b if a is None or (b is not None and b[:2] < a[:2]) else a

    for i in range(n, -1, -1):
        here = {q: None for q in range(4)}
        if i == n:
            here = dict(after)
        else:
            lat = cr.Lattice(initials, fault)
            for q in range(4):
                for letter, nxt, cost, role in lat._row(i, q):
                    tail = after[nxt]
                    if tail is not None:
                        turn = () if letter == "D" else ((i, role),)
                        here[q] = better(here[q], (cost + tail[0], letter + tail[1], turn + tail[2]))
        for _ in range(4):
            for q in range(4):
                for r in "ua":
                    if (q, r) in cr.STEP and here[cr.STEP[q, r]] is not None:
                        tail = here[cr.STEP[q, r]]
                        here[q] = better(here[q], (5 + tail[0], "I" + tail[1], ((None, r),) + tail[2]))
        after = here
    return after[0][0], after[0][1], list(after[0][2])


def random_case(rng, n):
    initials = [rng.choice("suaxs") for _ in range(n)]
    fault = [rng.choice(["", "", "truncated", "blank", "duplicate"]) for _ in range(n)]
    return initials, fault


def test_against_exhaustive_search():
    rng = random.Random(7)
    for _ in range(300):
        initials, fault = random_case(rng, rng.randint(0, 4))
        cost, audit, _ = cr.repair(cr.Lattice(initials, fault))
        assert (cost, audit) == exhaustive(initials, fault), (initials, fault)


def test_against_layered_programme_on_long_conversations():
    rng = random.Random(11)
    for _ in range(60):
        initials, fault = random_case(rng, rng.randint(5, 120))
        assert cr.repair(cr.Lattice(initials, fault)) == layered(initials, fault)


def test_ties_take_the_least_audit():
    # a lone user turn: insert an assistant (5) or delete it (2): delete
    assert cr.repair(cr.Lattice(["u"], [""]))[:2] == (2, "D")
    # assistant first: rerole to user and insert an assistant after (6) or delete (2)
    assert cr.repair(cr.Lattice(["a", "u", "a"], ["", "", ""]))[:2] == (2, "DKK")
    assert cr.repair(cr.Lattice([], []))[:2] == (0, "")


def reference(rows):
    """The whole query in plain Python: rows of (conv_id, turn, role, text)."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub(r"[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        by_conv[conv] += [(turn, role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, got in by_conv.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        roles, texts = [r[1] for r in got], [r[2] for r in got]
        fault = cr.faults(roles, texts)
        initials = [r[:1] for r in roles]
        cost, audit, turns = layered(initials, fault)
        lines = [f"{cr.ROLES[r] if r else roles[k]}:{texts[k] if k is not None else ''}" for k, r in turns]
        known = [r[0] for r in got if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in cr.LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal,
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


AWKWARD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hello there."), (1, 2, "assistant", "Hi"),
    (1, 2, "assistant", "Hi"), (1, 4, "user", "   "), (1, None, "user", "first of all."),
    (2, 0, None, None), (2, 1, "assistant", "x" * 100_000 + "."),
    (None, 3, "user", "no conversation id."), (None, 4, "assistant", "fine."),
    (3, 5, "user", "same turn a."), (3, 5, "user", "same turn b."), (3, 5, "tool", "zzz"),
] + [(4, t, ("user", "assistant")[t % 2], f"turn {t} says something.") for t in range(40)]
FIELDS = "conv_id long, turn long, role string, text string, dropped boolean, _h int, audit int, cost string"


def test_awkward_rows(spark):
    df = spark.createDataFrame([(*r, True, 1, 2, "c") for r in AWKWARD], FIELDS)
    got = cr.repair_conversations(df).collect()
    assert sorted((tuple(r)[:9] for r in got), key=repr) == reference(AWKWARD)
    assert {r["conv_id"] for r in got} == {1, 2, 3, 4, None}


def test_empty_table(spark):
    assert cr.repair_conversations(spark.createDataFrame([], FIELDS)).collect() == []


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = cr.repair_conversations(df).collect()
    assert sorted((tuple(r)[:9] for r in got), key=repr) == reference(rows)
    assert any(r["cost"] > 0 for r in got)
