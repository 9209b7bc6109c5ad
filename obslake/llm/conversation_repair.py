"""Conversation structure repair: bidirectional Dijkstra over the edit lattice of each conversation.

A repaired conversation has role initials of the form ``(s?(ua)+)?``: an optional system turn, then
user and assistant turns in pairs. Each row is kept (cost 0), given the role user or assistant
(Rerole, 1), or deleted (2); a user or assistant turn with empty text can be inserted anywhere (5).
Blank rows (no character outside ``[\\x20\\x09-\\x0D]``) and duplicates (role and text seen earlier
in the conversation) must go; a truncated row (last such character not one of ``.!?``) that stays
costs 5 more. A row's first fault in that order is its fault.

The lattice has a node (rows consumed, state of the grammar) for every row and each of four states
(start, after system, after user, after assistant) and a sink behind the accepting ends. A forward
search from the start and a reverse search from the sink run by turns, each from its heap of least
distance; they stop when the two heap tops add up to more than the best crossing, so every crossing
of equal cost is finished. The reverse search is then completed up to that cost, so every node on a
cheapest path knows its distance to the sink, and the audit is read by walking from the start along
cheapest edges, always taking the ASCII-least letter (D < I < K < R) and ending as soon as the
sink is reached at the least cost: the least concatenated audit of all cheapest edit sequences.
From one node each letter leads to one node, so the audit fixes the repaired conversation.

Damage, before the repair: rows are keyed by ``crc32("conv_id:turn")`` (UTF-8; a null is one
space there, and a null role or text is one space) modulo 20: 0 drops the row, 1 empties its text,
2 removes its ``.!?``, 3 repeats it (same turn), 4 makes its role user. The rows that remain are
taken by turn, nulls first, then by role and text (ties of equal rows are interchangeable).

Per original conv_id (a null conv_id is one conversation): gaps (max turn - min turn + 1 - distinct
turns over non-null turns, 0 without), counts of blank, duplicate and truncated rows, illegal
adjacent pairs (initials not su, ua or au), the least cost, the audit and the SHA-256 of the repaired
``role:text`` lines joined by newlines. A conversation with no rows after damage has zeros, an empty
audit and the hash of the empty text, as has one whose every row is deleted. Very long texts are
hashed whole; other input columns are ignored. One conversation is one unit of work: its rows go to
one task, which holds one conversation at a time (a few dozen bytes per row besides its texts).
"""

from __future__ import annotations

import hashlib
import heapq
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: The grammar (s?(ua)+)? as a table: state, role initial -> state. 0 start, 1 after s, 2 after u, 3 after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = ("su", "ua", "au")
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string, n_rows long")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, and dropped (kept so that every conv_id stays)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_h"))
    h = F.col("_h")
    return rows.select(
        "conv_id", "turn",
        F.when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
        .alias("text"),
        (h == 0).alias("dropped"),
        F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def faults(roles: list[str], texts: list[str]) -> list[str]:
    """First fault of each row in order: 'blank', 'duplicate', 'truncated' or ''."""
    seen, out = set(), []
    for role, text in zip(roles, texts):
        body = text.rstrip(SPACE)
        if not body.strip(SPACE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif body[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


class Lattice:
    """Edit lattice of one conversation: nodes (i, state) and the sink ``None``."""

    def __init__(self, initials: list[str], fault: list[str]):
        self.initials, self.fault, self.n = initials, fault, len(initials)

    def _row(self, i: int, state: int):
        """(letter, next state, cost, new role initial or None) of the edits that consume row i."""
        yield "D", state, DELETE, None
        if self.fault[i] in ("blank", "duplicate"):
            return
        extra = TRUNCATED if self.fault[i] == "truncated" else 0
        if (state, self.initials[i]) in STEP:
            yield "K", STEP[state, self.initials[i]], KEEP + extra, None
        for role in "ua":
            if role != self.initials[i] and (state, role) in STEP:
                yield "R", STEP[state, role], REROLE + extra, role

    def out(self, node):
        """(letter, node, cost, role) of the edges leaving a node."""
        if node is None:
            return
        i, state = node
        if i < self.n:
            for letter, nxt, cost, role in self._row(i, state):
                yield letter, (i + 1, nxt), cost, role
        for role in "ua":
            if (state, role) in STEP:
                yield "I", (i, STEP[state, role]), INSERT, role
        if i == self.n and state in ACCEPT:
            yield "", None, 0, None

    def into(self, node):
        """(node, cost) of the edges entering a node."""
        if node is None:
            for state in ACCEPT:
                yield (self.n, state), 0
            return
        i, target = node
        for state in range(4):
            for role in "ua":
                if STEP.get((state, role)) == target:
                    yield (i, state), INSERT
            if i > 0:
                for _, nxt, cost, _ in self._row(i - 1, state):
                    if nxt == target:
                        yield (i - 1, state), cost


def _order(node, reverse: bool) -> int:
    """Among equal distances, nodes that free edges lead from come first (free edges consume a row)."""
    if node is None:
        return -(1 << 62)
    return -node[0] if reverse else node[0]


def repair(lattice: Lattice) -> tuple[int, str, list]:
    """(least cost, least audit, [(row or None, role initial or None)] of the repaired turns)."""
    start = (0, 0)
    dist = [{start: 0}, {None: 0}]
    done = [set(), set()]
    heaps = [[(0, _order(start, False), 0, start)], [(0, _order(None, True), 0, None)]]
    tick, best = 1, inf

    def top(side):
        heap = heaps[side]
        while heap and heap[0][3] in done[side]:
            heapq.heappop(heap)
        return heap[0][0] if heap else inf

    def settle(side):
        nonlocal tick, best
        d, _, _, node = heapq.heappop(heaps[side])
        done[side].add(node)
        edges = ((v, c) for _, v, c, _ in lattice.out(node)) if side == 0 else lattice.into(node)
        for v, cost in edges:
            nd = d + cost
            if nd < dist[side].get(v, inf):
                dist[side][v] = nd
                heapq.heappush(heaps[side], (nd, _order(v, side == 1), tick, v))
                tick += 1
            if v in dist[1 - side]:
                best = min(best, nd + dist[1 - side][v])

    # the two searches meet; stop once no crossing of equal cost can still be found
    while True:
        forward, backward = top(0), top(1)
        if forward + backward > best or (forward == inf and backward == inf):
            break
        settle(0 if forward <= backward else 1)
    # finish the reverse side up to the least cost: every node of a cheapest path knows its rest
    while top(1) <= best:
        settle(1)
    rest = {v: d for v, d in dist[1].items() if v in done[1]}
    node, spent, letters, turns = start, 0, [], []
    while True:
        edges = [(letter, v, cost, role) for letter, v, cost, role in lattice.out(node)
                 if v in rest and spent + cost + rest[v] == best]
        if any(v is None for _, v, _, _ in edges):
            break
        letter, v, cost, role = min(edges, key=lambda e: e[0])
        if letter in "KR":
            turns.append((node[0], role))
        elif letter == "I":
            turns.append((None, role))
        letters.append(letter)
        node, spent = v, spent + cost
    return best, "".join(letters), turns


def _gaps(turns: list) -> int:
    known = [t for t in turns if t is not None]
    return max(known) - min(known) + 1 - len(set(known)) if known else 0


NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _one(conv_id, rows: list[tuple]) -> tuple:
    """The result row of one conversation from its (turn, role, text, dropped) rows."""
    rows = sorted(((t, r, x) for t, r, x, gone in rows if not gone),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    fault = faults(roles, texts)
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, audit, turns = repair(Lattice(initials, fault))
    digest = hashlib.sha256()
    for k, (row, role) in enumerate(turns):
        line = f"{ROLES[role] if role else roles[row]}:{texts[row] if row is not None else ''}"
        digest.update(((k and "\n" or "") + line).encode())
    counts = [sum(f == kind for f in fault) for kind in ("blank", "duplicate", "truncated")]
    return (conv_id, _gaps([r[0] for r in rows]), *counts, illegal, cost, audit, digest.hexdigest(), len(rows))


def _stream(batches):
    """Conversations of a partition sorted by conv_id, one at a time; a conversation may span batches."""
    schema = pa.schema([pa.field(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in NAMES])
    current, rows, first = None, [], True
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped")]
        for conv_id, *row in zip(*columns):
            if not first and conv_id != current:
                out.append(_one(current, rows))
                rows = []
            current, first = conv_id, False
            rows.append(tuple(row))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(k).type) for k, c in enumerate(zip(*out))],
                                             schema=schema)
    if not first:
        last = _one(current, rows)
        yield pa.RecordBatch.from_arrays([pa.array([v], schema.field(k).type) for k, v in enumerate(last)],
                                         schema=schema)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per original conv_id with the columns of ``RESULT``; see the module."""
    rows = damaged(conversations)
    # every row of a conversation to one partition, in a run of its own: a task streams them one by one
    return rows.repartition("conv_id").sortWithinPartitions("conv_id").mapInArrow(_stream, RESULT)
