import hashlib

import pytest

from obslake.llm import substrings
from tests.llm.conftest import ALL_IDS, TEXTS, ids


def brute_force(documents, window=13):
    """doc_id and text pairs -> rows of the query."""
    first = {}
    held = [(d, (t or "").encode().split()) for d, t in documents]
    order = lambda d: substrings.LAST if d is None else d
    for d, w in held:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, substrings.LAST), order(d))
    out = []
    for d, w in held:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < order(d):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


SMALL = {"block_bytes": 20_000, "segment_bits": 10, "group_windows": 5_000}


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_awkward_texts(awkward, sizes):
    got = substrings.remove_repeated_windows(awkward, keep_text=False, **sizes).collect()
    assert ids(got) == ALL_IDS
    assert sorted(map(tuple, got), key=repr) == brute_force(TEXTS)


def test_many_blocks_and_segments_give_the_same(documents, texts):
    got = substrings.remove_repeated_windows(documents, keep_text=False, **SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force([(d, t) for d, (t, _) in texts.items()])


def test_crowded_sketch_loses_nothing(spark):
    """With hardly any counters everything looks repeated, and the exact pass decides alone."""
    shared = " ".join(f"s{i}" for i in range(15))
    rows = [(i, f"{shared} " + " ".join(f"d{i}x{k}" for k in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeated_windows(df, keep_text=False, block_bytes=500).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(rows)
    assert sum(r["n_removed"] for r in got) == 39 * 15


def test_kept_text(spark):
    words = " ".join(f"w{i}" for i in range(13))
    df = spark.createDataFrame([(1, words), (2, f"before\n{words}  after")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substrings.remove_repeated_windows(df).collect()}
    assert got == {1: words, 2: "before after"}


def test_no_rows(nothing):
    assert substrings.remove_repeated_windows(nothing).collect() == []


def test_texts_are_shuffled_once(documents):
    plan = substrings.remove_repeated_windows(documents)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text[:text.index("Initial Plan")]
    assert final.count("FileScan") + final.count("RoundRobin") <= 2 and final.count("ReusedExchange") >= 2


def _one_block(rows, window=13, bits=12, segment_bits=10, groups=2, order_ask=None, order_remove=None):
    """The five passes on one block, called directly, each pass may see the rows in its own order."""
    import pyarrow as pa

    def table(order):
        chosen = [rows[i] for i in order] if order is not None else rows
        return pa.table({"doc_id": pa.array([d for d, _ in chosen], pa.int64()),
                         "text": pa.array([t for _, t in chosen], pa.string())})

    key = (pa.scalar(0, pa.int64()),)
    sketch = substrings._sketch(window, bits, segment_bits)(key, table(None))
    merged = [substrings._merge_sketches(segment_bits)((pa.scalar(p, pa.int64()),), sketch.filter(
        pa.compute.equal(sketch.column("part"), p))) for p in sorted(set(sketch.column("part").to_pylist()))]
    answers = pa.concat_tables(merged)
    asked = substrings._ask(window, bits, segment_bits, groups)(key, table(order_ask), answers)
    grouped = pa.concat_tables([substrings._group_exactly((pa.scalar(p, pa.int64()),), asked.filter(
        pa.compute.equal(asked.column("part"), p))) for p in sorted(set(asked.column("part").to_pylist()))])
    out = substrings._remove(window, groups, False)(key, table(order_remove), grouped)
    return sorted(zip(*(out.column(c).to_pylist() for c in out.column_names)), key=repr)


def test_rows_in_another_order_in_each_pass():
    """Shuffled rows reach the passes of a block in any order; the result must not depend on it."""
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(i, f"own{i} words {shared} tail{i} " + " ".join(f"d{i}x{k}" for k in range(15))) for i in range(40)]
    rows += [(7, f"again {shared} once more"), (None, shared), (41, None), (42, "")]
    expected = brute_force(rows)
    forward = list(range(len(rows)))
    assert _one_block(rows, order_ask=forward, order_remove=forward[::-1]) == expected
    assert _one_block(rows, order_ask=forward[::-1], order_remove=forward[3:] + forward[:3]) == expected
