"""Secret scan with format grammars that are inferred from labelled credentials.

Fixed patterns find base spans in every text: assignments, access keys and runs of hex digits. Their
values are labelled credentials. From a bounded sample of the distinct values of each kind
(``SAMPLE``, the first in an order of hashes) a prefix tree is built, and states whose outgoing
frequencies are statistically compatible (Hoeffding bound) are merged into a probabilistic automaton.
Every other candidate, a run of credential characters with letters and digits, is scored by the
automata; one whose likelihood per character is like that of the labelled values is a further span
of kind ``format``.

Texts are read once: a batch of bytes is searched for key words and long runs first, and the patterns
run only on texts that hold any. Null text: no spans. Rows with equal doc_id are rows of their own.
No labelled credential at all: base spans only (there are none, then).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm import textbatch as tb
from obslake.session import materialise

#: The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "format")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
SAMPLE = 300
#: Characters of labelled values that a grammar of a kind is learned from at most (values are whole; the
#: values are taken in an order of hashes while they fit). Candidates are scored whole.
SAMPLE_CHARS = 100_000
ALPHA = 0.05
#: Share of the labelled values that may score below the limit.
BELOW = 0.02
_RUN = np.zeros(256, dtype=bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the fixed patterns, by start and then kind as listed."""
    found = [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(found, key=_order)


def _order(span):
    return span[0], KINDS.index(span[2]), span[1]


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, *_ in spans)


def candidates(text: str, base) -> list[tuple[int, int, str]]:
    """Runs with letters and digits that no base span touches; dots and signs at their end are cut."""
    out = []
    for m in CANDIDATE.finditer(text):
        value = m[0].rstrip(".=-").lstrip(".=-")
        start = m.start() + len(m[0]) - len(m[0].lstrip(".=-"))
        end = start + len(value)
        if (len(value) >= 16 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                and not any(s < end and start < e for s, e, *_ in base)):
            out.append((start, end, value))
    return out


def concerned(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that may hold a span: those with a key word, a long hex run, or a long run with a digit."""
    flags = np.zeros(len(offsets) - 1, dtype=bool)
    raw = data.tobytes()
    low = raw.lower()
    for word, where in [*((w, low) for w in KEYWORDS), (b"AKIA", raw)]:
        at = where.find(word)
        while at >= 0:
            flags[np.searchsorted(offsets, at, side="right") - 1] = True
            at = where.find(word, at + 1)
    for table, digits in ((_HEX, False), (_RUN, True)):
        starts, ends = tb.segments(table[data], offsets)
        long = ends - starts >= 16
        starts, ends = starts[long], ends[long]
        if digits:
            count = np.append(0, np.cumsum(_DIGIT[data]))
            starts = starts[count[ends] > count[starts]]
        flags[tb.owner(offsets, starts)] = True
    return flags


_VALUE = pa.struct([("kind", pa.string()), ("value", pa.string())])
_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
_BASE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
SCANNED = ("doc_id long, base array<struct<start:long,end:long,kind:string>>, "
           "labelled array<struct<kind:string,value:string>>, "
           "candidates array<struct<start:long,end:long,value:string>>")


def _scan(batches):
    for batch in tb.pieces(batches, "text"):
        texts = tb.column_of(batch, "text")
        flags = concerned(*tb.utf8(texts)).tolist()
        bases, values, others = [], [], []
        for i, flag in enumerate(flags):
            text = texts[i].as_py() if flag else None
            spans = base_spans(text) if text else []
            bases.append([{"start": s, "end": e, "kind": k} for s, e, k, _ in spans])
            values.append([{"kind": k, "value": v} for _, _, k, v in spans])
            others.append([{"start": s, "end": e, "value": v} for s, e, v in candidates(text, spans)]
                          if text else [])
        yield pa.RecordBatch.from_arrays([
            tb.column_of(batch, "doc_id"), pa.array(bases, pa.list_(_BASE)),
            pa.array(values, pa.list_(_VALUE)), pa.array(others, pa.list_(_CANDIDATE)),
        ], names=["doc_id", "base", "labelled", "candidates"])


class Grammar:
    """Probabilistic automaton inferred from strings by state merging."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.next: list[dict[str, int]] = [{}]
        self.passed: list[dict[str, int]] = [defaultdict(int)]
        self.ended: list[int] = [0]
        for string in strings:
            state = 0
            for symbol in string:
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.passed.append(defaultdict(int))
                    self.ended.append(0)
                self.passed[state][symbol] += 1
                state = self.next[state][symbol]
            self.ended[state] += 1
        self._merge()
        scores = sorted(self.score(s) for s in strings)
        self.limit = scores[int(BELOW * len(scores))] if scores else 0.0

    def _count(self, state: int) -> int:
        return self.ended[state] + sum(self.passed[state].values())

    def _alike(self, a: int, n: int, b: int, m: int) -> bool:
        if n == 0 or m == 0:
            return True
        return abs(a / n - b / m) < self._bound * (n**-0.5 + m**-0.5)

    def compatible(self, a: int, b: int) -> bool:
        """Whether two states may be one: they and their successors end and go on at like rates."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self._count(a), self._count(b)
            if not self._alike(self.ended[a], n, self.ended[b], m):
                return False
            for symbol in self.passed[a].keys() | self.passed[b].keys():
                if not self._alike(self.passed[a].get(symbol, 0), n, self.passed[b].get(symbol, 0), m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    stack.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, state: int) -> None:
        stack = [(into, state)]
        while stack:
            into, state = stack.pop()
            self.ended[into] += self.ended[state]
            for symbol, count in self.passed[state].items():
                self.passed[into][symbol] += count
                if symbol in self.next[into]:
                    stack.append((self.next[into][symbol], self.next[state][symbol]))
                else:
                    self.next[into][symbol] = self.next[state][symbol]

    def _merge(self) -> None:
        """Settled states grow from the root; each successor joins a compatible one or is settled."""
        settled, waiting = [0], sorted(self.next[0].items())
        sources = [(0, symbol) for symbol, _ in waiting]
        while sources:
            source, symbol = sources.pop(0)
            state = self.next[source][symbol]
            if state in settled:
                continue
            for other in settled:
                if self.compatible(other, state):
                    self.next[source][symbol] = other
                    before = set(self.next[other])
                    self._fold(other, state)
                    sources += [(other, s) for s in sorted(set(self.next[other]) - before)]
                    break
            else:
                settled.append(state)
                sources += [(state, s) for s in sorted(self.next[state])]
            # folding may have hung unsettled states below any settled one
            if not sources:
                sources = [(s, c) for s in settled for c in sorted(self.next[s]) if self.next[s][c] not in settled]
        self.states = len(settled)

    def score(self, string: str) -> float:
        """Mean log2-likelihood per symbol, the end included; minus infinity if it is not accepted."""
        state, total = 0, 0.0
        for symbol in string:
            count = self.passed[state].get(symbol, 0)
            if not count:
                return -math.inf
            total += math.log2(count / self._count(state))
            state = self.next[state][symbol]
        if not self.ended[state]:
            return -math.inf
        return (total + math.log2(self.ended[state] / self._count(state))) / (len(string) + 1)


def infer(scanned: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> dict[str, Grammar]:
    """A grammar per kind, from the first ``sample`` distinct labelled values in an order of hashes, whole,
    as far as they fit in ``chars`` characters."""
    labelled = scanned.select(F.explode("labelled").alias("v")).select("v.kind", "v.value").distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = labelled.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample).collect()
    strings, used = defaultdict(list), defaultdict(int)
    for row in sorted(rows, key=lambda r: (r["kind"], r["_n"])):
        if used[row["kind"]] + len(row["value"]) <= chars:
            strings[row["kind"]].append(row["value"])
            used[row["kind"]] += len(row["value"])
    return {kind: Grammar(values) for kind, values in strings.items()}


def _score(grammars):
    def run(batches):
        for batch in batches:
            base, asked = batch.column("base").to_pylist(), batch.column("candidates").to_pylist()
            counts = {k: [] for k in KINDS}
            digests, texts, best = [], [], []
            for spans, others in zip(base, asked):
                found = [(s["start"], s["end"], s["kind"]) for s in spans]
                added, scores = [], []
                for c in others:
                    margin = max((g.score(c["value"]) - g.limit for g in grammars.value.values()), default=-math.inf)
                    if margin >= 0:
                        added.append((c["start"], c["end"], "format"))
                        scores.append(margin)
                for kind in KINDS:
                    counts[kind].append(sum(s[2] == kind for s in (*found, *added)))
                digests.append(hashlib.sha256(joined(found).encode()).hexdigest())
                texts.append(joined(sorted([*found, *added], key=_order)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS[:3]),
                pa.array(digests, pa.string()), pa.array(texts, pa.string()), pa.array(counts["format"], pa.int64()),
            ], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])
    return run


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (all, as kind:start:end) and n_format."""
    scanned = materialise(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCANNED), "spans")
    grammars = scanned.sparkSession.sparkContext.broadcast(infer(scanned))
    return scanned.select("doc_id", "base", "candidates").mapInArrow(
        _score(grammars), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_format long")
