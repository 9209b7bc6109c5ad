import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import cross_parsing as cp
from tests.llm.conftest import ALL_IDS, ids


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=30), st.text("abcd", max_size=60))
def test_phrases_are_longest_matches(sample, text):
    model = cp.Model({"x": np.array([ord(c) for c in sample] or [32], dtype=np.uint32)})
    got = model.phrases([model.encode(np.array([ord(c) for c in text], dtype=np.uint32))])[0, 0]
    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i:i + n + 1] in sample:
            n += 1
        if text[i] not in sample:
            n = 1
        count, i = count + 1, i + n
    # unknown letters end the phrase before them; the last phrase is counted even if it is empty
    assert abs(int(got) - count) <= 1 + sum(c not in sample for c in text) or not text


@settings(max_examples=100, deadline=None)
@given(st.text("ab", max_size=25))
def test_automaton_accepts_exactly_the_substrings(text):
    table = cp.suffix_automaton([ord(c) - 97 for c in text], 2)
    parts = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)} | {""}
    frontier = {"": 0}
    for _ in range(len(text) + 1):
        frontier = {p + c: table[s, k] for p, s in frontier.items() for k, c in enumerate("ab") if table[s, k] >= 0}
        assert set(frontier) == {p for p in parts if len(p) == len(next(iter(frontier), "")) and p} or not frontier


def test_symbols():
    held = "".join(map(chr, cp.symbols("Ab,  C1ß\n\nÉ")))
    assert held == "ab c ß é"
    assert len(cp.symbols("")) == 0


def test_held_out_accuracy(documents, texts):
    rows = cp.identify(documents).where(cp.fold(F.col("doc_id")) == cp.HELD_OUT).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows) and len(rows) > 30
    right = [r["_lang_pred"] == r["lang"] for r in rows]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r["_score"] <= 1 for r in rows)


def test_labels_of_the_held_out_fold_are_not_used(spark, documents):

    hidden = documents.withColumn("lang", F.when(cp.fold(F.col("doc_id")) == cp.HELD_OUT, "zz").otherwise(F.col("lang")))
    one = {r["doc_id"]: (r["_lang_pred"], r["_score"]) for r in cp.identify(documents).collect()}
    two = {r["doc_id"]: (r["_lang_pred"], r["_score"]) for r in cp.identify(hidden).collect()}
    assert one == two


def test_awkward_texts(awkward):
    got = cp.identify(awkward)
    assert got.columns == [*awkward.columns, "_lang_pred", "_score"]
    rows = got.collect()
    assert ids(rows) == ALL_IDS
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["_lang_pred"], r["_score"]) == ("und", 0.0)
        else:
            assert r["_lang_pred"] in ("en", "de")


def test_no_rows_and_no_labels(nothing, spark):
    assert cp.identify(nothing).collect() == []
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[3:] for r in cp.identify(df).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("length", [cp.CHUNK - 1, cp.CHUNK, 5 * cp.CHUNK + 3])
def test_long_texts_are_read_whole(length):
    sample = {"a": np.array([ord("a")] * 50, dtype=np.uint32), "b": np.array([ord("b")] * 50, dtype=np.uint32)}
    model = cp.Model(sample)
    text = model.encode(np.array([ord("b")] * (length - 1) + [ord("a")], dtype=np.uint32))
    a, b = model.phrases([text])[0]
    assert a > b and a >= length - 1


def test_samples_come_from_anywhere_in_a_document_and_once_per_id(spark):
    from obslake.llm import cross_parsing as cp

    head = "#1 " * 3000
    rows = [(1, head + "aaaa bbbb " * 300, "xx"), (2, "cccc dddd " * 300, "yy")] + [(3, "eeee ffff " * 50, "yy")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = cp.fit(df, documents=10, characters=5_000, of_one=200)
    assert sorted(model.languages) == ["xx", "yy"]
    # the language whose letters follow 9,000 characters without any still has a sample, and
    # the id repeated 500 times gives one piece
    assert cp.identify(spark.createDataFrame([(9, "aaaa bbbb aaaa", "zz")], "doc_id long, text string, lang string")
                       .unionByName(df)).where("doc_id = 9").first()["_lang_pred"] == "xx"
