"""Periodic run detection on a grammar: Re-Pair the word ids, find runs at each rule's boundary once.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``max(6, 4q)`` words long, that no neighbouring word extends with period q. Words of a run after its
first q are dropped (the stretch collapses to one period).

Per document:

1. Re-Pair in rounds: every adjacent pair of symbols that occurs twice or more becomes a rule
   (overlapping occurrences of a pair alternate), until no pair repeats. A repetitive text shrinks to
   a few symbols; a plain text keeps most words.
2. Each distinct rule ``X -> Y Z`` is looked at once, on its expansion: a window of ``max(6, 4q)``
   words of a run lies in some lowest rule, where it crosses the border between Y and Z, so it holds
   ``max(3, 2q)`` words on one side of that border whole; hence for each q only the two ends of the
   pairs that such a side needs are tested, for all rules at once, and the q-periodic stretch around
   a match is extended to both sides inside the expansion. Above the rules, the top-level symbols
   are joined by a balanced tree whose nodes are treated alike.
3. Each stretch found in a rule is translated to every position where the rule occurs in the
   derivation; stretches of the same period that overlap by q words or more are merged. The merged
   stretches are the maximal q-periodic stretches; one that is also periodic with a smaller period is
   found again with it, and the smallest period is kept.

Documents are independent: the work is one pass over the rows with no shuffle. Null text: no words;
empty and blank texts: no words. Null doc_id: no re-parameterised tail. Rows are judged one by one, so
repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.session import spread

LEAST = 6
TIMES = 4
#: Hits of periods up to this have all their pairs compared at once before any extension.
VERIFIED = 64
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RESULT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def planted(doc_id: int | None, words: list) -> list:
    """The words with the tail that the doc_id's crc32 re-parameterises into a periodic one."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def re_pair(seq: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(top-level symbols, rules): rule r makes symbol ``first + r`` of (left, right)."""
    rules: list[tuple[int, int]] = []
    nxt = int(seq.max()) + 1 if len(seq) else 0
    seq = seq.astype(np.int64)
    while len(seq) >= 2:
        codes = seq[:-1] * (1 << 31) + seq[1:]
        _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
        at = np.flatnonzero(counts[inverse] >= 2)
        if not len(at):
            break
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = at[1:] != at[:-1] + 1
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
        pairs, which = np.unique(codes[at], return_inverse=True)
        rules.extend(zip((pairs >> 31).tolist(), (pairs & ((1 << 31) - 1)).tolist()))
        seq = seq.copy()
        seq[at] = nxt + which
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
        nxt += len(pairs)
    return seq, rules


def _reach(equal, start: int, limit: int, step: int) -> int:
    """How far pairs keep matching from ``start`` towards ``limit`` (exclusive), in growing chunks."""
    done, chunk = 0, 32
    while True:
        todo = min(chunk, abs(limit - start) - done)
        if todo <= 0:
            return done
        at = start + step * (done + np.arange(todo))
        miss = np.flatnonzero(~equal(at))
        if len(miss):
            return done + int(miss[0])
        done, chunk = done + todo, chunk * 2


def _extend(w: np.ndarray, lo: int, hi: int, i: int, q: int) -> tuple[int, int]:
    """Maximal stretch in w[lo:hi] of pairs (j, j + q) of equal words around the matching pair i."""
    def equal(j):
        return w[j] == w[j + q]
    left = i - _reach(equal, i - 1, lo - 1, -1)
    right = i + _reach(equal, i + 1, hi - q, 1)
    return left, right + q + 1


def _need(q: np.ndarray) -> np.ndarray:
    """Least length of a run of period q."""
    return np.maximum(LEAST, TIMES * q)


def _at_borders(w: np.ndarray, lo: np.ndarray, hi: np.ndarray, border: np.ndarray, most: int, shared: int):
    """(node, start, end, q) of q-periodic stretches of w[lo:hi] that hold a run-long window across the border.

    A window of ``max(6, 4q)`` words across the border holds ``h = max(3, 2q)`` words on one side of it
    whole, so the pairs from border - 1 to border + h - q - 1, or those from border - h to border - q,
    all match; both ends of either range are tested for all nodes and periods at once, then the pairs
    between them, and only the stretches around a hit are extended. Nodes from ``shared`` on are those of
    the top-level tree.
    """
    top = np.minimum((hi - lo) // TIMES, most)
    top[hi - lo < LEAST] = 0
    node = np.repeat(np.arange(len(lo)), top)
    if not len(node):
        return []
    q = np.arange(len(node)) - np.repeat(np.cumsum(top) - top, top) + 1
    lo_, hi_, b = lo[node], hi[node], border[node]
    half = np.maximum(LEAST // 2, 2 * q)

    def match(j):
        ok = (j >= lo_) & (j + q < hi_)
        out = np.zeros(len(j), dtype=bool)
        out[ok] = w[j[ok]] == w[j[ok] + q[ok]]
        return out

    hits, starts = [], []
    for first, last in ((b - 1, b + half - q - 1), (b - half, b - q)):
        hit = np.flatnonzero(match(first) & match(last))
        small = hit[q[hit] <= VERIFIED]
        if len(small):
            # then every pair between the two ends, for all hits of short periods at once
            count = last[small] - first[small] + 1
            pairs = np.repeat(first[small], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            qs = np.repeat(q[small], count)
            whole = np.logical_and.reduceat(w[pairs] == w[pairs + qs], np.cumsum(count) - count)
            hit = np.concatenate([small[whole], hit[q[hit] > VERIFIED]])
        hits.append(hit)
        starts.append(first[hit])
    hit, first = np.concatenate(hits), np.concatenate(starts)
    scope = np.where(node[hit] >= shared, -1, node[hit])
    order = np.lexsort((q[hit], scope))
    # per scope (a rule, or the whole text for the top-level tree) the stretches found, smallest periods first:
    # inside a stretch of period p the maximal stretch of any multiple of p is that same stretch
    known: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
    found = set()
    for k, at in zip(hit[order].tolist(), first[order].tolist()):
        n, qq = int(node[k]), int(q[k])
        key = -1 if n >= shared else n
        if _inside(known, key, at, qq):
            continue
        n_lo, n_hi = int(lo_[k]), int(hi_[k])
        if key == -1:
            # a node of the top-level tree has one place: its stretch may run on over the whole text
            s, e = _extend(w, 0, len(w), at, qq)
        else:
            # a rule is short beside the text: compare all its pairs at once
            miss = np.flatnonzero(w[n_lo:n_hi - qq] != w[n_lo + qq:n_hi]) + n_lo
            cut = np.searchsorted(miss, at)
            s = int(miss[cut - 1]) + 1 if cut else n_lo
            e = (int(miss[cut]) if cut < len(miss) else n_hi - qq) + qq
        starts_, ends_ = known.setdefault((key, qq), ([], []))
        place = bisect.bisect(starts_, s)
        starts_.insert(place, s)
        ends_.insert(place, e)
        if e - s >= max(LEAST, TIMES * qq):
            found.add((n, s - n_lo, e - n_lo, qq))
    return sorted(found)


def _divisors(q: int) -> list[int]:
    small = [d for d in range(1, int(q ** 0.5) + 1) if q % d == 0]
    return small + [q // d for d in small if d * d != q]


def _inside(known: dict, key: int, at: int, q: int) -> bool:
    """Whether the pairs at..at+q lie in a stretch found in this scope whose period divides q."""
    for p in _divisors(q):
        held = known.get((key, p))
        if held:
            k = bisect.bisect_right(held[0], at) - 1
            # maximal stretches of one period overlap by less than it, so only the latest one starting
            # at or before ``at`` can hold the q + 1 words from it
            if k >= 0 and held[1][k] > at + q:
                return True
    return False


def _repeats_a_five_gram(ids: np.ndarray) -> bool:
    """Whether some five consecutive word ids occur twice (by a 64-bit hash; a collision only costs time).

    A run of period q has at least ``max(6, 4q) - q >= 5`` consecutive pairs of equal words q apart, so
    the five words from its start recur q words later: a text without a repeated five-gram has no run.
    """
    if len(ids) < LEAST:
        return False
    with np.errstate(over="ignore"):
        h = np.zeros(len(ids) - 4, dtype=np.uint64)
        for k in range(5):
            h = (h ^ ids[k:len(ids) - 4 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return len(np.unique(h)) < len(h)


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word ids, by start, then period."""
    n = len(ids)
    most = n // TIMES
    if most < 1 or not _repeats_a_five_gram(ids):
        return []
    top, rules = re_pair(ids)
    base = int(ids.max()) + 1
    left = np.array([r[0] for r in rules], dtype=np.int64)
    right = np.array([r[1] for r in rules], dtype=np.int64)
    size = np.ones(base + len(rules), dtype=np.int64)
    for r, (a, b) in enumerate(rules):
        size[base + r] = size[a] + size[b]
    # occurrences of every rule in the derivation, level by level
    at = np.concatenate([[0], np.cumsum(size[top])[:-1]]).astype(np.int64)
    sym = top.astype(np.int64)
    occ_sym, occ_at = [], []
    while len(sym):
        inner = sym >= base
        sym, at = sym[inner], at[inner]
        occ_sym.append(sym)
        occ_at.append(at)
        r = sym - base
        sym = np.concatenate([left[r], right[r]])
        at = np.concatenate([at, at + size[left[r]]])
    occ_sym, occ_at = np.concatenate(occ_sym), np.concatenate(occ_at)
    order = np.lexsort((occ_at, occ_sym))
    occ_sym, occ_at = occ_sym[order], occ_at[order]
    first_of = np.flatnonzero(np.r_[True, occ_sym[1:] != occ_sym[:-1]]) if len(occ_sym) else np.zeros(0, np.int64)
    rule_sym = occ_sym[first_of]
    # nodes: each rule once, on its first expansion; then a balanced tree over the top-level symbols
    node_lo = [occ_at[first_of]]
    node_hi = [occ_at[first_of] + size[rule_sym]]
    node_border = [occ_at[first_of] + size[left[rule_sym - base]]]
    edges = np.concatenate([[0], np.cumsum(size[top])]).astype(np.int64)
    span = 1
    while span < len(top):
        k = np.arange(0, len(top) - span, 2 * span)
        node_lo.append(edges[k])
        node_border.append(edges[k + span])
        node_hi.append(edges[np.minimum(k + 2 * span, len(top))])
        span *= 2
    lo, hi, border = (np.concatenate(x).astype(np.int64) for x in (node_lo, node_hi, node_border))
    n_rules = len(rule_sym)
    bounds = np.r_[first_of, len(occ_sym)]
    stretches: dict[int, list[tuple[int, int]]] = {}
    for node, s, e, q in _at_borders(ids, lo, hi, border, most, len(rule_sym)):
        # a rule's stretch holds at every place of the rule in the derivation
        places = occ_at[bounds[node]:bounds[node + 1]] if node < n_rules else lo[node:node + 1]
        stretches.setdefault(q, []).extend(zip((places + s).tolist(), (places + e).tolist()))
    best: dict[tuple[int, int], int] = {}
    for q, spans in stretches.items():
        spans.sort()
        s, e = spans[0]
        for s2, e2 in spans[1:] + [(n + q + 1, n + q + 1)]:
            if s2 <= e - q:
                e = max(e, e2)
                continue
            if e - s >= max(LEAST, TIMES * q):
                best[s, e] = min(best.get((s, e), q), q)
            s, e = s2, e2
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def _one(doc_id, text: bytes | None) -> tuple:
    words = planted(doc_id, WORD.findall(text) if text is not None else [])
    ids = pc.dictionary_encode(pa.array(words, pa.binary())).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = runs_of(ids)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        gone[s + q] += 1
        gone[s + length] -= 1
    dropped = np.cumsum(gone[:-1]) > 0
    kept = b" ".join(w for w, d in zip(words, dropped.tolist()) if not d)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    head = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(words), len(runs), *head, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def _batches(batches):
    names = [n.split()[0] for n in RESULT.split(", ")]
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        rows = [_one(d, t) for d, t in zip(ids, texts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.string() if k >= 7 else pa.int64()) for k in range(9)], names=names)


def find_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256,
    collapsed_sha256 of every row of ``documents``; see the module."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a table of few splits (one row group) would be one task: deal its rows to all cores first
    return spread(rows).mapInArrow(_batches, RESULT)
