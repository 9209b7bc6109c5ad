from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import robust_outliers as ro
from tests.llm.conftest import ALL_IDS, ids


def plain(text):
    text = text or ""
    words = text.encode().split()
    triples = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é😀", max_size=40)), max_size=5))
def test_statistics(texts):
    found = ro.statistics(pa.array(texts, pa.string()))
    got = list(zip(*(found[n].tolist() for n in NAMES)))
    assert got == [plain(t) for t in texts]


def test_given_documents(documents, texts):
    rows = ro.judge(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        expected = plain(texts[r["doc_id"]][0])
        assert tuple(r[n] for n in NAMES) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    passed = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] for r in passed) > 0.85 * len(passed)


def test_awkward_texts(awkward, nothing):
    rows = ro.judge(awkward).collect()
    assert ids(rows) == ALL_IDS
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)
    assert ro.judge(nothing).collect() == []


def numeric(spark, groups):
    """Rows with given transformed statistics."""
    rows = [(n, g, s, False, *map(float, x)) for n, (g, s, x) in enumerate(groups)]
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(
        f"{f} double" for f in ro.FEATURES))


def reference(data):
    """The same estimate in NumPy, with exact quantiles."""
    tolerance = np.diag(np.array(list(ro.TOLERANCE.values())) ** 2)
    lower = lambda x: np.sort(x, axis=0)[int(np.ceil(0.5 * len(x))) - 1]
    mean = lower(data)
    spread = 1.4826 * lower(np.abs(data - mean))
    inverse = np.linalg.inv(np.diag(spread**2) + tolerance)
    for step in range(ro.STEPS):
        d = np.einsum("ni,ij,nj->n", data - mean, inverse, data - mean)
        ordered = np.sort(d)
        limit, median = (ordered[int(np.ceil(q * len(d))) - 1] for q in (ro.SHARE, 0.5))
        inside = data[d <= limit]
        mean, cov = inside.mean(axis=0), np.cov(inside.T, bias=True)
        cov = cov * (median / ro.chi_square(0.0) if step == ro.STEPS - 1 else 1.0) + tolerance
        inverse = np.linalg.inv(cov)
    return mean, inverse


def test_estimate_equals_numpy_and_resists_outliers(spark):
    draw = np.random.Generator(np.random.PCG64(11))
    size = len(ro.FEATURES)
    mixed = draw.normal(size=(size, size))
    clean = draw.normal(size=(800, size)) @ mixed
    far = draw.normal(size=(150, size)) + 40.0
    groups = {("en", "a"): np.vstack([clean, far]), ("en", None): clean[:300] * 0.1 + 5}
    rows = numeric(spark, [(g, s, x) for (g, s), data in groups.items() for x in data])
    models = {(r["lang"], r["source"]): r for r in ro.estimate(rows, ["lang", "source"]).collect()}
    for key, data in groups.items():
        mean, inverse = reference(data)
        got = models[key]
        assert np.allclose([got[f"m{i}"] for i in range(size)], mean, rtol=1e-3, atol=1e-3)
        assert np.allclose([got[f"p{i}_{j}"] for i, j in ro._PAIRS], [inverse[i, j] for i, j in ro._PAIRS], rtol=2e-2, atol=2e-2)
    mean, _ = reference(groups["en", "a"])
    assert np.abs(mean).max() < 2  # the far 16 percent do not pull it


def test_junk_is_rejected_and_small_groups_use_their_language(spark):
    draw = np.random.Generator(np.random.PCG64(2))
    vocabulary = [f"word{i}" for i in range(5000)]

    def text(n, junk=False):
        words = draw.choice(vocabulary, n)
        return " ".join(w + "###$$$" * junk for w in words)

    rows = [(i, text(int(draw.integers(80, 600))), "en", "big") for i in range(150)]
    rows += [(1000 + i, text(200), "en", "small") for i in range(5)] + [(2000, text(200), "xx", None)]
    rows += [(3000, text(200, junk=True), "en", "big"), (3001, text(200, junk=True), "en", "small")]
    got = {r["doc_id"]: r["kept"] for r in ro.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    assert not got[3000] and not got[3001]
    assert all(kept for i, kept in got.items() if i < 3000)


def test_chi_square():
    # the cube-root transformation is within a hundredth of the exact quantiles for 5 degrees
    assert ro.chi_square(0.0) == pytest.approx(4.351, abs=0.02)
    assert ro.chi_square(2.326) == pytest.approx(15.09, abs=0.1)
