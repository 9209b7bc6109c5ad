from collections import defaultdict

import pytest

from obslake.llm import line_runs
from tests.llm.conftest import ALL_IDS, TEXTS, ids


def brute_force(documents, min_words=8):
    """(doc_id, text) without lines of any run of min_words words or more that occurred before."""
    order = lambda d: line_runs.LAST if d is None else d
    first, runs = {}, []
    for d, t in set(documents):
        lines = t.split("\n") if t is not None else []
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += len(lines[j].encode().split())
                if words >= min_words:
                    run, place = tuple(lines[i:j + 1]), (order(d), i)
                    first[run] = min(first.get(run, place), place)
                    runs.append((d, t, place, run))
    gone = defaultdict(set)
    for d, t, place, run in runs:
        if first[run] < place:
            gone[d, t].update(range(place[1], place[1] + len(run)))
    return {(d, t if t is None else "\n".join(
        x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])) for d, t in documents}


def kept(df, min_words=8):
    return {(r["doc_id"], r["text"]) for r in line_runs.delete_repeated_runs(df, min_words, whole=True).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


TEN = "one two three four five six seven eight nine ten"


def test_a_run_with_a_short_last_line_goes_whole(spark):
    rows = [(1, f"{TEN}\nAll rights reserved.\nfirst text"), (2, f"{TEN}\nAll rights reserved.\nsecond text")]
    assert kept(frame(spark, rows)) == {rows[0], (2, "second text")}


def test_an_exact_copy_with_short_last_lines_is_emptied(spark):
    text = f"{TEN}\nbye\n\nnow" + "\n" * 40
    assert kept(frame(spark, [(1, text), (2, text), (3, "bye\n\nnow")])) == {(1, text), (2, ""), (3, "bye\n\nnow")}


def test_runs_within_a_text_and_short_lines(spark):
    rows = [(1, "a b\nc d\na b\nc d\na b\nc d\na b\nc d\na b\nc d\nx\na b"), (2, "c d\na b\nc d\na b\nc d\nx\na b\nc d"),
            (3, "x\na b\nc d\na b\nc d\nx\na b"), (None, "c d\na b\nc d\na b\nc d\nx\na b\nq")]
    for least in (1, 3, 8):
        assert kept(frame(spark, rows), least) == brute_force(rows, least)


@pytest.mark.parametrize("min_words", [1, 3, 8, 20])
def test_given_documents(documents, texts, min_words):
    assert kept(documents, min_words) == brute_force([(d, t) for d, (t, _) in texts.items()], min_words)


def test_awkward_texts(awkward, nothing):
    rows = line_runs.delete_repeated_runs(awkward, whole=True).collect()
    assert ids(rows) == ALL_IDS
    assert {(r["doc_id"], r["text"]) for r in rows} == brute_force(TEXTS)
    assert line_runs.delete_repeated_runs(nothing, whole=True).collect() == []
