import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import nbest_pieces as nb
from tests.llm.conftest import ALL_IDS, TEXTS, ids


@pytest.fixture(scope="module")
def encoder():
    return nb.Encoder(nb.default_model())


def all_segmentations(pieces, unit):
    begins = [(b & 0xC0) != 0x80 for b in unit] + [True]
    out = []

    def go(start, score, found):
        if start == len(unit):
            out.append((score, tuple(found)))
            return
        for end in range(start + 1, len(unit) + 1):
            held = unit[start:end]
            if held in pieces.found:
                i = pieces.found[held]
                go(end, score + pieces.score[i], [*found, i])
            elif begins[start] and begins[end] and sum(begins[start:end]) == 1:
                go(end, score + pieces.fallback, [*found, *(int(pieces.byte_id[b]) for b in held)])

    go(0, 0.0, [])
    return sorted(out, key=lambda r: -r[0])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abeinorst é😀", min_size=1, max_size=7))
def test_search_finds_the_best_of_all(encoder, text):
    for unit in [b for b in (" " + text).encode().split(b"\n") if b]:
        expected = all_segmentations(encoder.pieces, unit)
        got = nb.a_star(encoder.pieces, unit, 6)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in expected[:6]])
        assert len({i for _, i in got}) == len(got) and {i for _, i in got} <= {i for _, i in expected}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abeinorst\n é", max_size=9))
def test_n_best_of_a_text(encoder, text):
    """Combining the units of least gap gives what all segmentations of the whole text give."""
    ids_, cut, best, others = encoder.encode(pa.array([text]))
    if not text:
        assert len(ids_) == 0 and others == [[]]
        return
    expected = all_segmentations(encoder.pieces, (" " + text).encode())
    scores = [best[0] + loss for loss, _ in others[0]]
    assert scores == pytest.approx([s for s, _ in expected[:nb.NBEST]])
    assert encoder.pieces.decode(ids_.tolist()) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=5))
def test_round_trip(encoder, texts):
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids_, cut, _, _ = encoder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert encoder.pieces.decode(ids_[cut[i]:cut[i + 1]].tolist()) == (text or "")


def test_combine_is_best_first():
    draw = np.random.Generator(np.random.PCG64(1))
    options = [sorted(draw.integers(-50, 0, 4).tolist(), reverse=True) for _ in range(4)]
    every = sorted((a + b + c + d for a in options[0] for b in options[1] for c in options[2] for d in options[3]), reverse=True)
    assert [s for s, _ in nb.combine(options, 20)] == every[:20]


def test_awkward_texts(awkward, nothing):
    rows = nb.encode(awkward).collect()
    assert ids(rows) == ALL_IDS
    of = dict(TEXTS)
    for r in rows:
        assert (r["_ids"] is None) == (of[r["doc_id"]] is None)
        if r["_ids"] is not None:
            assert r["_round_trip"] and len(r["_ids"]) == r["_n_ids"] and r["text"] == of[r["doc_id"]]
            assert r["_scores"] == sorted(r["_scores"], reverse=True)
    assert nb.encode(nothing).collect() == []
