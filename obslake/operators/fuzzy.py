"""Exact best-match search under the token-sorted indel ratio, as an equi-join.

The ratio of two texts is 100 * (1 - d / T), where d is the number of inserted and deleted
characters and T the sum of the lengths. A ratio of at least t allows d <= T * (1 - t / 100), and d
is odd or even like T; let D be the largest such d. Cut the canonical text into D + 1 pieces: D edits
leave a piece untouched, and one of those (number i from 0) has at most i edits before it and at most
D - i after it: pieces passed less edits met falls from 0 to below 0 by at most one a piece, and the
piece where it leaves 0 is such a one. Edits before a piece move it by at most their number, edits
behind it make up for the rest of the difference in length, so only a few places of the other text
can hold it. Every pair above the threshold shares (length, D, number of pieces, piece number, piece
text), hashed to one equi-join key; nothing is compared all against all and no match is lost.

The fewer the pieces, the longer and rarer they are. Where more canonical names than ``CROWDED``
share a piece, a finer cut of which the rarest D + 1 pieces are taken is tried too, and each
canonical name keeps the cut whose pieces fewer names share.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from obslake.operators.lookup import ROW_OVERHEAD, measured_bytes
from obslake.session import materialise

SPACES = r"(?U)[\s\x1c-\x1f]+"
# texts up to this length are scored many at a time, a bit per character
WORD = 64
# below this ratio a text may be shorter than the number of pieces it has to be cut into
LOWEST_THRESHOLD = 67.0
NAMES_PER_TASK = 50_000
# a piece that more canonical names share than this is spread over so many tasks
CROWDED = 100
SALTS = 16
# canonical pieces up to this measured size are broadcast; the driver holds them several times over
BROADCAST_LIMIT = 16 * 1024 * 1024
# below this many pairs one pass is cheaper than several
FEW_PAIRS = 1_000_000
FIRST_THRESHOLDS = (94.0,)


def sorted_tokens(name: Column) -> Column:
    """Lower-cased words in sorted order, joined by one space."""
    lower = F.lower(name)
    return F.when(lower.rlike(SPACES), F.array_join(F.array_sort(F.split(lower, SPACES)), " ")).otherwise(lower)


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of ``a``."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        used = free & positions.get(ch, 0)
        free = ((free + used) | (free - used)) & full
    return len(a) - free.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    return (1.0 - (total - 2 * _common_subsequence(a, b)) / total) * 100.0


def _code_points(texts: np.ndarray, lengths: np.ndarray, filler: int) -> np.ndarray:
    """One row of code points per text, filled up to the longest; a text may hold any character."""
    width = max(1, int(lengths.max()))
    points = texts.astype(f"U{width}").view(np.uint32).reshape(len(texts), width).astype(np.int32)
    points[np.arange(width) >= lengths[:, None]] = filler
    return points


def _common_subsequences(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """``_common_subsequence`` of many pairs at once; ``a`` has at most 64 characters."""
    pattern, text = _code_points(a, la, -1), _code_points(b, lb, -2)
    bits = np.uint64(1) << np.arange(pattern.shape[1], dtype=np.uint64)
    full = np.where(la > 0, ~np.uint64(0) >> (64 - np.maximum(la, 1)).astype(np.uint64), np.uint64(0))
    free = full.copy()
    for ch in text.T:
        used = free & np.where(pattern == ch[:, None], bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        free = ((free + used) | (free - used)) & full
    return la - np.bitwise_count(free).astype(np.int64)


@F.pandas_udf(DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    scores = np.empty(len(a), dtype="float64")
    a, b = a.to_numpy(dtype=object), b.to_numpy(dtype=object)
    la, lb = (np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) for texts in (a, b))
    longest = np.maximum(la, lb)
    for i in np.flatnonzero(longest > WORD):
        scores[i] = indel_ratio(a[i], b[i])
    # pairs of about one length go together, so that short ones are not filled up to long ones
    for upper in range(WORD // 4, WORD + 1, WORD // 4):
        some = np.flatnonzero((longest <= upper) & (longest > upper - WORD // 4) | (longest == 0) & (upper == WORD))
        if len(some):
            total = la[some] + lb[some]
            edits = total - 2 * _common_subsequences(a[some], b[some], la[some], lb[some])
            scores[some] = np.where(total == 0, 100.0, (1.0 - edits / np.maximum(total, 1)) * 100.0)
    return pd.Series(scores)


def _allowed(la: Column, lb: Column, threshold: float) -> Column:
    """Most edits a match may have; their number is odd or even like the sum of the lengths."""
    most = F.floor((la + lb) * F.lit((100.0 - threshold) / 100.0) + F.lit(1e-9)).cast("int")
    return F.greatest(F.lit(0), most - (most + la + lb) % 2)


def _shortest(length: Column, threshold: float) -> Column:
    share = threshold / (200.0 - threshold)
    return F.greatest(F.lit(1), F.ceil(length * F.lit(share) - F.lit(1e-9)).cast("int"))


def _longest(length: Column, threshold: float) -> Column:
    share = (200.0 - threshold) / threshold
    return F.floor(length * F.lit(share) + F.lit(1e-9)).cast("int")


def _piece_start(length: Column, pieces: Column, i: Column) -> Column:
    """0-based start of piece i; the last ``length % pieces`` pieces are one character longer."""
    short = pieces - length % pieces
    return i * F.floor(length / pieces).cast("int") + F.greatest(F.lit(0), i - short)


def _piece_length(length: Column, pieces: Column, i: Column) -> Column:
    return F.floor(length / pieces).cast("int") + (i >= pieces - length % pieces).cast("int")


def _fewest(allowed: Column) -> Column:
    """Into how many pieces a text is cut: one more than there may be edits."""
    return allowed + 1


def _finer(allowed: Column, length: Column) -> Column:
    return F.greatest(_fewest(allowed), F.floor(length / 3).cast("int"))


def _key(piece_text: Column) -> Column:
    """Equal pieces have equal keys; names that meet by a clash of hashes are told apart by their score."""
    return F.xxhash64("lb", "allowed", "pieces", "piece", piece_text).alias("key")


def _cut(sized: DataFrame, pieces: Column) -> DataFrame:
    """The pieces of canonical names: (canonical, b, lb, allowed, pieces, piece, key)."""
    lb, pieces_, piece = F.col("lb"), F.col("pieces"), F.col("piece")
    text = F.substring("b", _piece_start(lb, pieces_, piece) + 1, _piece_length(lb, pieces_, piece))
    return (
        sized.withColumn("pieces", pieces)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces_ - 1)))
        .select("canonical", "b", "lb", "allowed", "pieces", "piece", _key(text))
    )


def _sized_canonicals(
    canonicals: DataFrame, threshold: float, lengths: DataFrame | None = None
) -> DataFrame:
    """(canonical, b, lb, allowed): one row for every number of edits that some length of name allows.

    ``lengths`` are the (lb, allowed) of the names that there are; without them every length counts.
    """
    lb = F.length("b")
    sized = canonicals.select("canonical", sorted_tokens(F.col("canonical")).alias("b")).withColumn("lb", lb)
    if lengths is not None:
        return sized.join(F.broadcast(lengths), "lb").select("canonical", "b", "lb", "allowed")
    of_names = F.sequence(_shortest(lb, threshold), _longest(lb, threshold))
    return sized.withColumn("allowed", F.explode(F.array_distinct(
        F.transform(of_names, lambda la: _allowed(la, lb, threshold)))))


def _sized_names(names: DataFrame, threshold: float) -> DataFrame:
    """(name, a, la, lb, allowed): one row for every length that a match may have."""
    la = F.col("la")
    shortest = _shortest(la, threshold)
    return (
        names.select("name", sorted_tokens(F.col("name")).alias("a"))
        .withColumn("la", F.length("a"))
        .withColumn("lb", F.explode(F.sequence(
            shortest, F.greatest(shortest, _longest(la, threshold)))))
        .withColumn("allowed", _allowed(la, F.col("lb"), threshold))
    )


def _crowded(cut: DataFrame) -> DataFrame:
    """(key, shared_by) of the pieces that many canonical names share."""
    return materialise(
        cut.groupBy("key").agg(F.count(F.lit(1)).alias("shared_by"))
        .where(F.col("shared_by") > CROWDED),
        "crowded-pieces")


def _canonical_pieces(
    names: DataFrame, canonicals: DataFrame, threshold: float
) -> tuple[DataFrame, DataFrame | None]:
    """The pieces that canonical names are looked up by, and the crowded ones among them, if any."""
    # a pair of numbers per length that occurs among the names, however many there are
    lengths = _sized_names(names, threshold).select("lb", "allowed").distinct()
    sized = materialise(_sized_canonicals(canonicals, threshold, lengths), "sized-names")
    cut = _cut(sized, _fewest(F.col("allowed")))
    crowded = _crowded(cut)
    if crowded.isEmpty():
        return cut, None
    # any allowed + 1 pieces of a finer cut will do, so take those that the fewest canonical names share
    of_name = ["canonical", "allowed"]
    crowd = cut.join(crowded, "key").groupBy("canonical", "b", "lb", "allowed").agg(
        F.sum("shared_by").alias("crowd"))
    finer = _cut(crowd.drop("crowd"), _finer(F.col("allowed"), F.col("lb")))
    shared = finer.groupBy("key").agg(F.count(F.lit(1)).alias("shared_by"))
    rarest = Window.partitionBy(*of_name).orderBy("shared_by", "piece")
    rare = finer.join(shared, "key").withColumn("_rank", F.row_number().over(rarest)).where(
        F.col("_rank") <= F.col("allowed") + 1)
    better = (
        rare.withColumn("_crowd", F.sum("shared_by").over(Window.partitionBy(*of_name)))
        .join(crowd.select(*of_name, "crowd"), of_name)
        .where(F.col("_crowd") < F.col("crowd")).select(*cut.columns)
    )
    better = materialise(better, "rare-pieces")
    chosen = materialise(
        cut.join(better.select(*of_name).distinct(), of_name, "left_anti")
        .select(*cut.columns).unionByName(better),
        "chosen-pieces")
    still = _crowded(chosen)
    return chosen, None if still.isEmpty() else still


def _name_pieces(
    names: DataFrame, threshold: float, many: bool, lengths: DataFrame | None = None
) -> DataFrame:
    """Every piece of a name that a canonical name may share; ``lengths`` are those that one has."""
    la, lb, allowed, pieces, piece = (F.col(c) for c in ("la", "lb", "allowed", "pieces", "piece"))
    cuts = [_fewest(allowed), _finer(allowed, lb)] if many else [_fewest(allowed)]
    sized = _sized_names(names, threshold).withColumn(
        "pieces", F.explode(F.array_distinct(F.array(*cuts))))
    if lengths is not None:
        sized = sized.join(F.broadcast(lengths), ["lb", "allowed", "pieces"], "left_semi")
    start, size = _piece_start(lb, pieces, piece), _piece_length(lb, pieces, piece)
    longer = la - lb
    deleted = F.floor((allowed - longer) / 2).cast("int")
    inserted = F.floor((allowed + longer) / 2).cast("int")
    before, after = F.least(piece, allowed), F.least(pieces - 1 - piece, allowed)
    first = F.greatest(F.lit(0), start - F.least(deleted, before, after - longer))
    last = F.least(la - size, start + F.least(inserted, before, after + longer))
    return (
        sized.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .withColumn("from", F.explode(F.when(first <= last, F.sequence(first, last))))
        .select("name", "a", "allowed", _key(F.substring("a", F.col("from") + 1, size)))
    )


def _candidates(
    names: DataFrame, count: int, canonicals: DataFrame, threshold: float, many: bool
) -> DataFrame:
    """(name, canonical, a, b) that share a piece and are near enough by Levenshtein distance.

    Canonical pieces that are measured to fit are broadcast, and the names stay where they are.
    Beyond that both sides are shuffled; names are distinct, so a salt taken from the name spreads
    a crowded piece that many of them share evenly over the tasks. The join is told to shuffle: Spark
    takes the pieces of the names for as small as the names and would broadcast all of them.
    """
    # a name turns into many keys, so tasks are sized by names and not by their few bytes
    tasks = max(names.sparkSession.sparkContext.defaultParallelism, ceil(count / NAMES_PER_TASK))
    crowded = lengths = None
    if many:
        right, crowded = _canonical_pieces(names, canonicals, threshold)
        # a few numbers per length that occurs, however many canonical names there are
        lengths = right.select("lb", "allowed", "pieces").distinct()
    else:
        right = _cut(_sized_canonicals(canonicals, threshold), _fewest(F.col("allowed")))
    left = _name_pieces(names.repartition(tasks, "name"), threshold, many, lengths)
    right = right.select("canonical", "b", "key")
    keys = ["key"]
    fits = not many or right.count() * ROW_OVERHEAD <= BROADCAST_LIMIT
    fits = fits and measured_bytes(right) <= BROADCAST_LIMIT
    if fits:
        right = F.broadcast(right)
    else:
        if crowded is not None:
            spread = crowded.select("key", F.lit(SALTS).alias("salts"))
            salts = F.coalesce("salts", F.lit(1))
            left = left.join(spread, "key", "left").withColumn(
                "salt", F.pmod(F.xxhash64("name"), salts).cast("int"))
            right = right.join(spread, "key", "left").withColumn(
                "salt", F.explode(F.sequence(F.lit(0), salts - 1)))
            keys.append("salt")
        right = right.hint("merge")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in keys]
    near = F.expr("levenshtein(l.a, r.b, l.allowed) >= 0")
    pairs = left.alias("l").join(right.alias("r"), [*same, near]).select(
        "l.name", "r.canonical", "l.a", "r.b")
    # what follows is done per name, so the pairs are dealt out once
    return (pairs if fits else pairs.repartition("name")).distinct()


def _best_at(
    names: DataFrame, count: int, canonicals: DataFrame, threshold: float, many: bool
) -> DataFrame:
    """Best match at or above one threshold.

    Python scores only the pairs that can still be the best: the indel distance lies between the
    Levenshtein distance and twice that, less the difference in length, and it is odd or even like
    the sum of the lengths.
    """
    total, gap = F.length("a") + F.length("b"), F.abs(F.length("a") - F.length("b"))
    edits = F.levenshtein("a", "b")
    fewest = F.greatest(edits, gap)

    def score(distance: Column) -> Column:
        return (1.0 - distance / total) * 100.0

    bounded = _candidates(names, count, canonicals, threshold, many).withColumns({
        "most_score": score(fewest + (total - fewest) % 2),
        "least_score": score(2 * edits - gap),
    })
    of_name = Window.partitionBy("name")
    open_pairs = bounded.withColumn("sure", F.max("least_score").over(of_name)).where(
        F.col("most_score") >= F.greatest("sure", F.lit(threshold)))
    scored = open_pairs.select("name", "canonical", indel_ratio_udf("a", "b").alias("score"))
    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("canonical")))
    # the threshold is applied after the aggregation: a filter below it would score every pair twice
    return scored.groupBy("name").agg(best.alias("best")).select(
        "name", "best.canonical", (-F.col("best.minus")).alias("score")).where(
        F.col("score") >= threshold)


def best_fuzzy_match(names: DataFrame, canonicals: DataFrame, threshold: float) -> DataFrame:
    """(name, canonical, score) of the best canonical name at or above the threshold.

    Equal scores go to the canonical name that sorts first. With many names the search starts at
    high thresholds, which allow few edits and so have few, selective pieces: a name that finds a
    match there has found its best one, and only the others go on to the next threshold.
    """
    if threshold < LOWEST_THRESHOLD:
        raise ValueError(f"the threshold must be at least {LOWEST_THRESHOLD}")
    count = names.count()
    if count == 0:
        return names.select("name", F.lit("").alias("canonical"), F.lit(0.0).alias("score"))
    if count * canonicals.count() <= FEW_PAIRS:
        return _best_at(names, count, canonicals, threshold, many=False)
    found = []
    for step in [t for t in FIRST_THRESHOLDS if t > threshold] + [threshold]:
        best = materialise(_best_at(names, count, canonicals, step, many=True), "fuzzy-matches")
        found.append(best)
        names = materialise(names.join(best.select("name"), "name", "left_anti"), "open-names")
        count = names.count()
        if count == 0:
            break
    return reduce(DataFrame.unionByName, found)
