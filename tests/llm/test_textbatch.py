import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import textbatch as tb

TEXT = st.text(alphabet=" \t\n\r\x0b\x0cabAB  é😀.", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_bytes_split(texts):
    data, offsets = tb.utf8(pa.array(texts, pa.string()))
    starts, ends, text = tb.words(data, offsets)
    raw = data.tobytes()
    got = [[] for _ in texts]
    for s, e, t in zip(starts, ends, text):
        got[t].append(raw[s:e])
    assert got == [(t or "").encode().split() for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    words = ["a", "b", "ab", "ba", "aa", "x" * 50, "a", "ab", "y" * (tb.CHUNK + 5), "b"]
    data, offsets = tb.utf8(pa.array([" ".join(words)]))
    starts, ends, _ = tb.words(data, offsets)
    for lane in range(tb.LANES):
        hashes = tb.segment_hashes(data, starts, ends, lane)
        of = {}
        for word, value in zip(words, hashes.tolist()):
            assert of.setdefault(word, value) == value
        assert len(set(of.values())) == len(of)


def test_windows_depend_on_order_and_not_on_place():
    hashes = np.array([1, 2, 3, 1, 2, 3, 2, 1], dtype=np.uint64)
    got = tb.window_hashes(hashes, 3)
    assert got[0] == got[3] and len(set(got.tolist())) == 5
    assert len(tb.window_hashes(hashes, 9)) == 0


@pytest.mark.parametrize("size", [1, 10, 10**6])
def test_pieces_keep_all_rows(size):
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (0, 5, 100, 1)] + [None]})
    parts = list(tb.pieces(iter([batch]), "text", size))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_numbers_survive_packing():
    values = np.array([0, 1, 255, 2**40, 2**64 - 1], dtype=np.uint64)
    assert (tb.unpacked(tb.packed(values), 5, np.uint64) == values).all()
