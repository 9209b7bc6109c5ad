from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import order_minhash as om
from obslake.llm.tables import components
from tests.llm.conftest import ALL_IDS, ids


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def shingles(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def classes(rows):
    """Least id of each document's component, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingles(t) for _, t in rows]
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a is None or b is None:
                continue
            if a == b or (jaccard(sets[i], sets[j]) >= 0.8 and edits(a.split(), b.split()) <= 0.2 * max(
                    len(a.split()), len(b.split()))):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 14))
def test_banded_alignment_is_the_edit_distance(a, b, limit):
    got = om.banded_edits(np.array(a), np.array(b), limit)
    assert got == min(edits(a, b), limit + 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=20), st.lists(st.integers(0, 2), max_size=20))
def test_shingle_similarity(a, b):
    def sets(x):
        return Counter(tuple(x[i:i + 5]) for i in range(len(x) - 4)) if len(x) >= 5 else Counter([tuple(x)] if x else [])

    expected = jaccard(sets(a), sets(b)) if a and b else float(len(a) == len(b))
    got = om.shingle_similarity(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32))
    # below the limit a bound may be returned in place of the value
    assert got == pytest.approx(expected) or (got < om.SIMILARITY and expected < om.SIMILARITY)


def variants(n_groups=12, copies=9):
    rng = np.random.Generator(np.random.PCG64(3))
    rows = []
    for g in range(n_groups):
        base = [f"g{g}w{rng.integers(0, 400)}" for _ in range(int(rng.integers(60, 300)))]
        for c in range(copies):
            words = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 30)))):
                words[int(rng.integers(0, len(words)))] = f"new{rng.integers(0, 10**9)}"
            rows.append((g * 100 + c, " ".join(words)))
        half = len(base) // 2
        rows.append((g * 100 + 50, " ".join(base[half:] + base[:half])))  # the same passages in another order
    return rows


def test_planted_variants(spark):
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(df).collect()}
    expected = {rows[i][0]: rows[c][0] for i, c in enumerate(classes(rows))}
    assert got == expected
    assert all(got[g * 100 + 50] == g * 100 + 50 for g in range(12))


def test_chain_of_near_copies(spark):
    """Neighbours in a chain are alike, its ends are not: one class, found through several comparisons."""
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words = list(words)
        words[15 * k] = f"x{k}"
        words[15 * k + 7] = f"y{k}"
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}
    assert not om.similar(*(np.array([hash(w) & 0xFFFFFFFF for w in rows[i][1].split()], dtype=np.uint32) for i in (0, 11)))


def test_given_documents(documents, texts):
    rows = sorted((d, t) for d, (t, _) in texts.items())
    got = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(documents).collect()}
    sets = [shingles(t) for _, t in rows]
    expected = classes_by_shingles(rows, sets)
    assert got == expected


def classes_by_shingles(rows, sets):
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (d, a) in enumerate(rows):
        for j in range(i):
            e, b = rows[j]
            if a == b or jaccard(sets[i], sets[j]) >= 0.8:
                x, y = find(d), find(e)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def test_awkward_texts(awkward):
    rows = om.near_duplicates(awkward).collect()
    assert ids(rows) == ALL_IDS
    of = {r["doc_id"]: r["class_id"] for r in rows}
    assert of[6] == 1 and of[7] == 7 and of[3] == 3 and of[4] == 4 and of[5] == 5 and of[None] is None


def test_no_rows(nothing):
    assert om.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("links", [[], [(1, 2)], [(5, 4), (4, 3), (3, 2), (2, 1)], [(i, i + 1) for i in range(40)],
                                   [(0, i) for i in range(1, 30)] + [(100, i) for i in range(29, 60)], [(7, 7), (9, 8), (8, 9)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {n for link in links for n in link}
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {n: r for n, r in root.items() if n != r}
