"""Line dedup: a suffix array over line ids finds repeated runs of lines; later copies are deleted.

Every line is an id (128 bits of hash), every document a sequence of ids. Lines that occur once
cannot be part of a repeated run and only act as borders. The suffixes that start at the other
lines are sorted by distributed prefix doubling: with the ranks of all runs of 2^k lines known, the
rank of a run of 2^(k+1) lines follows from the ranks of its halves. A rank is (id of the first
line, number of suffixes of that bucket that sort before), so no global sort is needed: a round
counts distinct pairs of halves and takes prefix sums of these counts within a rank, over ranges of
the second half first and inside the ranges then, so a very frequent line is spread over many tasks.

The suffixes that share L lines form the LCP interval of depth L. It is found from ranks of level
k, 2^k <= L < 2^(k+1), as the pair of ranks of the run's first and last 2^k lines. A run counts if it
has at least ``min_words`` words, so the interval of interest at a line has the least depth L that
reaches them. All members of an interval but the first (least doc_id, then line) are marked, L lines
each, and marked lines are deleted.

These marks leave the end of a maximal repeated run: the lines after the last least run that fits into
it. With ``whole`` a line also asks for deeper intervals, up to the depth from which on the run without
its first line has ``min_words`` words too, for such a run is a later copy of its own and is marked from
the next line. So every line of a later copy of a run of at least ``min_words`` words is deleted, and no
depth beyond these can add one. The depths asked for are at most two per line of the corpus in all.

Null text: no lines, stays null. Empty text: one empty line. Rows that agree in doc_id and text are one
document and keep the same lines. Null doc_id sorts last. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.llm import textbatch as tb
from obslake.llm.tables import Carried
from obslake.session import materialise

MIN_WORDS = 8
#: The high bits of the second half, 4096 ranges, over which the prefix sums of one rank are spread.
SPAN_SHIFT = 52
DOC = ["_doc", "_tk"]
LAST = 2**63 - 1


def _lines(min_words: int, whole: bool):
    """Lines of each document with two hashes, and how many lines from here reach ``min_words``.

    With ``whole`` also ``deepest``: how many lines from here the next line does not answer for.
    """
    def run(batches):
        for batch in tb.pieces(batches, "text"):
            data, offsets = tb.utf8(tb.column_of(batch, "text"))
            breaks = np.flatnonzero(data == 10)
            starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
            ends = np.sort(np.concatenate([breaks, offsets[1:]]))
            lines = np.diff(np.searchsorted(breaks, offsets)) + 1
            doc = np.repeat(np.arange(batch.num_rows), lines)
            first = np.cumsum(lines) - lines
            number = np.arange(len(starts)) - first[doc]
            word_starts, _, _ = tb.words(data, offsets)
            reach = np.searchsorted(word_starts, ends)
            before = np.searchsorted(word_starts, starts)
            last = np.searchsorted(reach, before + min_words)
            end = (first + lines)[doc]
            depth = np.where(last < end, last - np.arange(len(starts)) + 1, 0)
            deepest = np.minimum(np.append(last[1:], len(starts)), end) - np.arange(len(starts))
            more = [pa.array(np.where(depth > 0, np.maximum(deepest, depth), 0), pa.int32())] if whole else []
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                tb.column_of(batch, "_doc").take(take), tb.column_of(batch, "_tk").take(take),
                pa.array(number, pa.int32()),
                pa.array(tb.segment_hashes(data, starts, ends, 0).view(np.int64)),
                pa.array(tb.segment_hashes(data, starts, ends, 1).view(np.int64)),
                pa.array(depth, pa.int32()), *more,
            ], names=["_doc", "_tk", "line", "h", "g", "depth", "deepest"][:6 + whole])
    return run


def line_ids(documents: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """(_doc, _tk, line, h, g, depth) of every line, with ``whole`` also deepest."""
    source = documents.where(F.col("text").isNotNull()).select(*_identity(documents), "text")
    return source.mapInArrow(
        _lines(min_words, whole),
        "_doc long, _tk long, line int, h long, g long, depth int" + ", deepest int" * whole)


def _depths(rows: DataFrame) -> list[str]:
    return [c for c in ("depth", "deepest") if c in rows.columns]


def _identity(documents: DataFrame):
    return (F.coalesce(documents["doc_id"].cast("long"), F.lit(LAST)).alias("_doc"),
            F.xxhash64(documents["text"]).alias("_tk"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Lines that occur more than once, with their rank of level 0: (h, o) and run length 1."""
    counts = lines.groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    before = Window.partitionBy("h").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.select("h", "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    return lines.join(ranked, ["h", "g"]).select(*DOC, "line", "h", "o", *_depths(lines), F.lit(1).alias("size"))


def _following(column: str, distance: int):
    """The value of the line ``distance`` lines below in the same document."""
    below = Window.partitionBy(*DOC).orderBy("line").rangeBetween(distance, distance)
    return F.first(column).over(below)


def double(ranked: DataFrame, reach: int) -> DataFrame:
    """Ranks of runs of 2 * reach lines from those of ``reach`` lines.

    ``size`` is the number of lines that the rank stands for: less than asked where the run meets
    a border. Runs that end there sort first.
    """
    whole = F.col("size") == reach
    paired = ranked.select(
        *DOC, "line", "h", "o", *_depths(ranked), "size",
        F.when(whole, _following("h", reach)).alias("h2"), F.when(whole, _following("o", reach)).alias("o2"),
        F.when(whole, _following("size", reach)).alias("size2"))
    paired = materialise(paired, "line-pairs")
    key = ["h", "o", "h2", "o2"]
    pairs = paired.groupBy(*key).agg(F.count("*").alias("n")).withColumn("span", F.shiftright("h2", SPAN_SHIFT))
    up_to = Window.unboundedPreceding
    spans = pairs.groupBy("h", "o", "span").agg(F.sum("n").alias("n"))
    below = Window.partitionBy("h", "o").orderBy(F.col("span").asc_nulls_first()).rowsBetween(up_to, -1)
    spans = spans.select("h", "o", "span", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"))
    inside = Window.partitionBy("h", "o", "span").orderBy(
        F.col("h2").asc_nulls_first(), F.col("o2").asc_nulls_first()).rowsBetween(up_to, -1)
    offsets = pairs.select(*key, "span", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("part"))
    a, b = offsets.alias("a"), spans.alias("b")
    offsets = a.join(b, [F.col("a.h") == F.col("b.h"), F.col("a.o") == F.col("b.o"),
                         F.col("a.span").eqNullSafe(F.col("b.span"))]).select(
        *[F.col(f"a.{c}") for c in key], (F.col("a.o") + F.col("b.base") + F.col("a.part")).alias("new"))
    p, q = paired.alias("p"), offsets.alias("q")
    joined = p.join(q, [F.col("p.h") == F.col("q.h"), F.col("p.o") == F.col("q.o"),
                        F.col("p.h2").eqNullSafe(F.col("q.h2")), F.col("p.o2").eqNullSafe(F.col("q.o2"))])
    return joined.select(
        *[F.col(f"p.{c}") for c in DOC], "p.line", "p.h", F.col("q.new").alias("o"), *[f"p.{c}" for c in _depths(ranked)],
        (F.col("p.size") + F.coalesce("p.size2", F.lit(0))).alias("size"))


def suffix_ranks(ranked: DataFrame, deepest: int | None = None) -> Iterator[tuple[int, DataFrame]]:
    """(run length, ranks) for lengths 1, 2, 4, ... up to ``deepest``, or until all suffixes are sorted.

    The last ranks are those of a full suffix array if ``deepest`` is not given.
    """
    reach = 1
    ranked = materialise(ranked, "line-ranks")
    while True:
        yield reach, ranked
        longest = ranked.agg(F.max("size").alias("n")).first()["n"]
        if longest is None or longest < reach or (deepest is not None and 2 * reach > deepest):
            return
        ranked, reach = materialise(double(ranked, reach), "line-ranks"), 2 * reach


def later_copies(lines: DataFrame) -> DataFrame:
    """(_doc, _tk, line, depth): runs of ``depth`` lines from ``line`` that have occurred before."""
    ranked = materialise(repeated_lines(lines), "repeated-lines")
    deepest = ranked.agg(F.max(_depths(ranked)[-1]).alias("n")).first()["n"] or 0
    found = []
    for reach, ranks in suffix_ranks(ranked, deepest):
        asked = ranks
        if "deepest" in ranks.columns:
            low, high = F.greatest("depth", F.lit(reach)), F.least("deepest", F.lit(2 * reach - 1))
            asked = ranks.where((F.col("depth") > 0) & (low <= high)).withColumn("depth", F.explode(F.sequence(low, high)))
        here = (F.col("depth") >= reach) & (F.col("depth") < 2 * reach)
        if reach > 1:
            # the rank of the run's last lines, which overlaps the first; a range frame can't vary by row
            ends = ranks.where(F.col("size") == reach).select(*DOC, F.col("line").alias("_end"), F.col("h").alias("h2"), F.col("o").alias("o2"))
            runs = asked.where(here & (F.col("size") == reach)).withColumn(
                "_end", F.col("line") + F.col("depth") - F.lit(reach)).join(ends, [*DOC, "_end"])
        else:
            runs = asked.where(here).withColumns({"h2": F.col("h"), "o2": F.col("o")})
        interval = ["depth", "h", "o", "h2", "o2"]
        place = F.struct(*DOC, "line")
        runs = materialise(runs.select(*DOC, "line", *interval), "line-runs")
        first = runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
        found.append(runs.join(first, interval).where(F.col("first") < place).select(*DOC, "line", "depth"))
    marks = found[0]
    for more in found[1:]:
        marks = marks.unionByName(more)
    return marks


RESULT = StructType().add("_n_lines", "long").add("_n_removed", "long")


def _delete(batches):
    for batch in batches:
        texts, starts, depths = (batch.column(c) for c in ("text", "starts", "depths"))
        out, total, gone = [], [], []
        for i in range(batch.num_rows):
            if not texts[i].is_valid:
                out.append(None)
                total.append(0)
                gone.append(0)
                continue
            lines = texts[i].as_py().split("\n")
            total.append(len(lines))
            if starts[i].is_valid:
                edges = np.zeros(len(lines) + 1, dtype=np.int64)
                begin = starts[i].values.to_numpy()
                np.add.at(edges, begin, 1)
                np.add.at(edges, begin + depths[i].values.to_numpy(), -1)
                keep = np.cumsum(edges[:-1]) == 0
                lines = [line for line, stays in zip(lines, keep.tolist()) if stays]
            out.append("\n".join(lines))
            gone.append(total[-1] - len(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            names=["row", "text", *RESULT.fieldNames()])


def delete_repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """The documents without later copies of repeated runs of lines, with _n_lines and _n_removed.

    ``whole``: to the end of each maximal run, not only as far as its least runs reach.
    """
    lines = materialise(line_ids(documents, min_words, whole), "lines")
    marks = later_copies(lines).distinct()
    of_doc = marks.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("line", "depth"))).alias("marks"))
    of_doc = materialise(of_doc.select(
        *DOC, F.col("marks.line").alias("starts"), F.col("marks.depth").alias("depths")), "line-marks")
    carried = Carried(documents, RESULT)
    joined = documents.select(carried.row, "text", *_identity(documents)).join(of_doc, DOC, "left")
    return carried.unpack(
        joined.select("row", "text", "starts", "depths").mapInArrow(_delete, carried.schema))
