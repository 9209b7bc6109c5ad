from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from obslake.llm import line_runs
from tests.llm.conftest import ALL_IDS, TEXTS, ids


def brute_force(documents, min_words=8):
    """doc_id -> text without lines covered by a least run of min_words words that occurred before."""
    order = lambda d: line_runs.LAST if d is None else d
    seen, runs = {}, []
    for d, t in sorted(documents, key=lambda r: order(r[0])):
        lines = t.split("\n") if t is not None else []
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += len(lines[j].encode().split())
                if words >= min_words:
                    run = tuple(lines[i:j + 1])
                    place = (order(d), t, i)
                    seen[run] = min(seen.get(run, place), place, key=lambda p: (p[0], p[2]))
                    runs.append((d, t, i, run))
                    break
    gone = defaultdict(set)
    for d, t, i, run in runs:
        if (seen[run][0], seen[run][2]) < (order(d), i):
            gone[d, t].update(range(i, i + len(run)))
    return {(d, t if t is None else "\n".join(
        x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])) for d, t in documents}


def kept(df, min_words=8):
    return {(r["doc_id"], r["text"]) for r in line_runs.delete_repeated_runs(df, min_words).collect()}


@pytest.mark.parametrize("min_words", [1, 3, 8, 20])
def test_given_documents(documents, texts, min_words):
    rows = [(d, t) for d, (t, _) in texts.items()]
    assert kept(documents, min_words) == brute_force(rows, min_words)


def test_awkward_texts(awkward):
    got = line_runs.delete_repeated_runs(awkward)
    assert got.columns == [*awkward.columns, "_n_lines", "_n_removed"]
    rows = got.collect()
    assert ids(rows) == ALL_IDS
    assert {(r["doc_id"], r["text"]) for r in rows} == brute_force(TEXTS)
    before = {r["doc_id"]: (r["_doc"], r["row"], r["h"]) for r in awkward.collect() if r["doc_id"] not in (7,)}
    assert all(before[r["doc_id"]] == (r["_doc"], r["row"], r["h"]) for r in rows if r["doc_id"] in before)


def test_no_rows(nothing):
    assert line_runs.delete_repeated_runs(nothing).collect() == []


def test_runs_of_short_lines_count_together(spark):
    block = "one two\nthree four\nfive six\nseven eight"
    df = spark.createDataFrame([(1, f"a\n{block}\nb"), (2, f"c\n{block}\nd"), (3, "one two\nthree four\nx")],
                               "doc_id long, text string")
    assert kept(df) == {(1, f"a\n{block}\nb"), (2, "c\nd"), (3, "one two\nthree four\nx")}


def test_suffix_array_is_sorted(spark):
    """Full doubling orders all suffixes of repeated lines as comparing their ids one by one does."""
    docs = [(1, "a\nb\na\nb\na\nc"), (2, "b\na\nb\na\nb"), (3, "a\nb\na\nb\na\nc"), (4, "c\nc\nc\nb\nunique\na")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lines = line_runs.line_ids(df, 1)
    ranked = line_runs.repeated_lines(lines)
    *_, (reach, last) = line_runs.suffix_ranks(ranked)
    assert reach >= 8
    hash_of = {(r["_doc"], r["line"]): r["h"] for r in ranked.collect()}

    def suffix(doc, line):
        out = []
        while (doc, line) in hash_of:
            out.append(hash_of[doc, line])
            line += 1
        return out

    rows = sorted(last.collect(), key=lambda r: (r["h"], r["o"]))
    suffixes = [suffix(r["_doc"], r["line"]) for r in rows]
    assert suffixes == sorted(suffixes)
    ranks = [(r["h"], r["o"]) for r in rows]
    for i in range(1, len(rows)):
        assert (ranks[i] == ranks[i - 1]) == (suffixes[i] == suffixes[i - 1])


def test_a_hot_line_is_spread_over_ranges(spark):
    """Distinct continuations of one line: prefix sums over ranges add up to a permutation."""
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit("hot"), F.concat(F.lit("n"), F.floor(F.col("id") / 2))).alias("text"))
    ranked = line_runs.repeated_lines(line_runs.line_ids(df, 1))
    (_, _), (_, two), *_ = line_runs.suffix_ranks(ranked, 2)
    hot = [r["o"] for r in two.where("line = 0").collect()]
    assert sorted(set(hot)) == list(range(0, 3000, 2)) and len(hot) == 3000
