"""One JSON object per file, read in byte ranges: the same entries at every cut; broken files fail."""

import json

import pytest

from obslake.sources import json_ranges

def text_of():
    # duplicate keys are kept in the text, in order
    parts = [f"{json.dumps(k)}: {json.dumps(v)}" for k, v in [
        ("One", {"headquarters": 'a, "quoted" {brace} [x]', "founded_year": 1}),
        ("Two", 'no object, but text with \\ and "'),
        ("Thr{ee}", {"nested": {"deep": [1, 2, {"x": ","}]}}),
        ("Four", []),
        ("Fünf 😀", {"headquarters": "ünï"}),
        ("One", {"headquarters": "later"})]]
    return "\n  {\n " + ",\n ".join(parts) + "\n}\n"


def entries(spark, path, size):
    rows = json_ranges.object_entries(spark, str(path), size).collect()
    return sorted((r["pos"], r["key"], json.loads(r["value"]) if r["value"][:1] in "[{\"" else r["value"])
                  for r in rows)


@pytest.mark.parametrize("size", [1, 5, 17, 64, 1 << 20])
def test_same_entries_at_every_range_size(spark, tmp_path, size):
    path = tmp_path / "c.json"
    path.write_text(text_of(), encoding="utf-8")
    got = entries(spark, path, size)
    assert [k for _, k, _ in got] == ["One", "Two", "Thr{ee}", "Four", "Fünf 😀", "One"]
    assert got == entries(spark, path, 1 << 20)
    assert got[0][2]["headquarters"] == 'a, "quoted" {brace} [x]' and got[-1][2] == {"headquarters": "later"}


def test_walk_agrees_at_every_cut():
    data = text_of().encode()
    whole = json_ranges.walk(data, False, False, 0)
    for cut in range(len(data) + 1):
        a = json_ranges.walk(data[:cut], False, False, 0)
        b = json_ranges.walk(data[cut:], *a[3])
        assert b[3] == whole[3]
        assert list(a[2]) + list(b[2]) == list(whole[2])


@pytest.mark.parametrize("text", ["[1, 2]", '{"a": 1} {"b": 2}', '{"a": 1', '{"a": 1,}', "  ", 'x{"a": 1}',
                                  '{"a": "open}'])
@pytest.mark.parametrize("size", [2, 1 << 20])
def test_broken_files_fail(spark, tmp_path, text, size):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises(Exception, match="JSON object"):
        json_ranges.object_entries(spark, str(path), size).collect()


def test_empty_object_has_no_entries(spark, tmp_path):
    path = tmp_path / "e.json"
    path.write_text(" { } \n")
    assert json_ranges.object_entries(spark, str(path), 2).collect() == []
    # a file of no bytes is skipped by Spark's file readers, as by the whole-text reader
    (tmp_path / "zero.json").write_text("")
    assert json_ranges.object_entries(spark, str(tmp_path / "zero.json"), 2).collect() == []


def test_many_entries_on_many_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text(json.dumps({f"c{i}": {"founded_year": i, "headquarters": f"h, {i}"} for i in range(20_000)}))
    got = json_ranges.object_entries(spark, str(path), 64 << 10)
    assert got.count() == 20_000
    assert got.filter("key = 'c19999'").first()["value"] == '{"founded_year":19999,"headquarters":"h, 19999"}'
