import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from obslake.llm import periodic_runs as pr


def brute_runs(ids):
    """Every maximal stretch with smallest period q and length >= max(6, 4q), by direct comparison."""
    n, found = len(ids), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ids[j] == ids[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q):
                found[s, e] = min(found.get((s, e), q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode()) if text is not None else []
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    ids = [hash(w) for w in words]
    runs = brute_runs(ids)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    head = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, n, len(runs), *head, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_runs_against_brute_force_on_random_sequences():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(0, 90)
        alphabet = rng.randint(1, 4)
        ids = [rng.randrange(alphabet) for _ in range(n)]
        if rng.random() < 0.5 and n > 10:
            a, p = rng.randrange(n // 2), rng.randint(1, 8)
            ids = ids[:a] + [ids[a + (i - a) % p] for i in range(a, n)]
        assert pr.runs_of(np.array(ids, dtype=np.int64)) == brute_runs(ids), ids


def test_re_pair_expands_to_the_input():
    rng = random.Random(5)
    ids = np.array([rng.randrange(3) for _ in range(300)], dtype=np.int64)
    top, rules = pr.re_pair(ids)
    base = int(ids.max()) + 1

    def expand(s):
        return [s] if s < base else expand(rules[s - base][0]) + expand(rules[s - base][1])
    assert [x for s in top.tolist() for x in expand(s)] == ids.tolist()
    assert len(top) < len(ids)


def test_planted_tail():
    words = [f"w{i}".encode() for i in range(50)]
    doc = next(d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0)
    got = pr.planted(doc, words)
    assert got != words and len(got) == 50
    assert pr.planted(None, words) == words and pr.planted(doc, []) == []


TEXTS = [
    (1, "a b c a b c a b c a b c x"), (2, None), (3, ""), (4, " \n\t "), (None, "z z z z z z z"),
    (5, "one two " * 3000), (5, "one two " * 3000), (6, "x" * 50_000),
    (7, " ".join(f"w{i % 97}" for i in range(5000))), (8, "aa bb aa bb aa bb aa bb aa\nbb cc"),
]
FIELDS = "doc_id long, text string, start int, period string, n_runs double"


def test_awkward_rows(spark):
    df = spark.createDataFrame([(d, t, 1, "p", 0.5) for d, t in TEXTS], FIELDS)
    got = sorted(map(tuple, pr.find_runs(df).collect()), key=repr)
    assert got == sorted((brute_row(d, t) for d, t in TEXTS), key=repr)
    by_id = {r[0]: r for r in got}
    assert by_id[2][1:3] == (0, 0) and by_id[2][3] is None
    assert by_id[5][2] == 1 and by_id[5][5] == 2


def test_empty_table(spark):
    assert pr.find_runs(spark.createDataFrame([], FIELDS)).collect() == []


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, pr.find_runs(df).collect()), key=repr)
    want = sorted((brute_row(d, t) for d, t in rows if t is None or len(t) < 20_000), key=repr)
    assert [g for g in got if g[0] in {w[0] for w in want}] == want
    assert any(g[2] > 0 for g in got)
