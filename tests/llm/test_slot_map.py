import zlib
from collections import Counter, defaultdict

import pytest

from obslake.llm import slot_map
from tests.llm.conftest import ALL_IDS, TEXTS, ids


def test_given_documents(documents, texts):
    rows = slot_map.assign(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    loads, places = Counter(), defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]][0] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None) and 0 <= r["shard"] < 24
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(loads) == 24
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(loads.values()) - min(loads.values()) <= max(r["size"] for r in rows)


def test_awkward_texts(awkward, nothing):
    rows = slot_map.assign(awkward, shards=3, slots=8).collect()
    assert ids(rows) == ALL_IDS
    sizes = sorted(len((t or "").encode()) + 8 for _, t in TEXTS)
    assert sorted(r["size"] for r in rows) == sizes
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert slot_map.assign(nothing).collect() == []


def greedy(sizes, shards):
    loads, chosen = [0] * shards, {}
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        shard = loads.index(min(loads))
        chosen[slot] = shard
        loads[shard] += sizes[slot]
    return chosen


def test_slots_go_to_the_emptiest_shard(spark):
    sizes = {s: (s * 7919) % 1000 for s in range(200)}
    df = spark.createDataFrame([(s, b, 1) for s, b in sizes.items()], "virtual_slot int, bytes long, rows long")
    got = {r["virtual_slot"]: r["shard"] for r in slot_map.first_map(df, 7).collect()}
    assert got == greedy(sizes, 7)


def test_a_new_shard_takes_slots_and_nothing_else_moves(spark, documents):
    records = slot_map.slotted(documents, 512)
    current = slot_map.first_map(slot_map.slot_bytes(records, 512), 6)
    before = {r["virtual_slot"]: r for r in current.collect()}
    total = sum(r["bytes"] for r in before.values())
    for shards in (6, 7):
        current = slot_map.add_shard(current, shards)
        after = {r["virtual_slot"]: r for r in current.collect()}
        assert set(after) == set(before) and {r["version"] for r in after.values()} == {shards - 4}
        moved = [s for s in after if after[s]["shard"] != before[s]["shard"]]
        assert moved and all(after[s]["shard"] == shards for s in moved)
        load = sum(after[s]["bytes"] for s in moved)
        assert 0.7 * total / (shards + 1) <= load <= total / (shards + 1)
        before = after


def test_versions_are_stored_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([(s, 10 + s, 1) for s in range(32)], "virtual_slot int, bytes long, rows long")
    one = slot_map.first_map(df, 3)
    two = slot_map.add_shard(one, 3)
    path = str(tmp_path / "map")
    slot_map.save_map(one, path)
    slot_map.save_map(two, path)
    rows = lambda m: sorted(map(tuple, m.collect()))
    assert rows(slot_map.load_map(spark, path)) == rows(two)
    assert rows(slot_map.load_map(spark, path, 1)) == rows(one)


def test_no_python_on_the_main_path(documents):
    plan = slot_map.assign(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("doc_id", [0, 1, 12345678901])
def test_slot_depends_on_the_id_alone(spark, doc_id):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(doc_id, "a"), (doc_id, "b"), (doc_id, None)], "doc_id long, text string")
    assert len({r[0] for r in df.select(slot_map.slot_of(F.col("doc_id"), F.col("text"))).collect()}) == 1
