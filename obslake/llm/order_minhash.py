"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text's k-mers are its windows of five words, each labelled with how often it has occurred before.
Each of 32 random orders picks the two least labelled k-mers and keeps them in text order; two such
pairs make a band. Texts that share a band are candidates. Because the pairs keep their order, texts
that hold the same passages in another order rarely meet.

Two texts are linked if their labelled k-mers have a Jaccard similarity of 0.8 or more, and a
banded alignment of their words finds an edit similarity (1 - edits / words of the longer) of 0.8
or more. At a Jaccard similarity of 0.8 a band is shared with probability 0.41 and one of the 16
bands with 0.9998.

Equal texts are one node. In each bucket of a band all members are compared with one of them, which
meets the most others, so a group of thousands of near copies costs one comparison per member and
band. Texts of buckets that then still hold several components are compared across components, by
an exact join on their rarest k-mers in place of all pairs of a bucket: it can add links, but loses
none that a bucket holds.

Null text: a class of its own. Texts without a word: equal ones are copies, nothing else. Texts of
fewer than five words have one k-mer, all their words. Rows with equal doc_id are kept as rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm import textbatch as tb
from obslake.llm.tables import checked_join, components
from obslake.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ORDERS_PER_BAND = 2
MAX = np.uint64(2**64 - 1)

_random = np.random.Generator(np.random.PCG64(7))
_SEEDS = _random.integers(0, 2**64, BANDS * ORDERS_PER_BAND, dtype=np.uint64)
_FACTORS = _random.integers(0, 2**64, BANDS * ORDERS_PER_BAND, dtype=np.uint64) | np.uint64(1)
_PAIR, _LABEL = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def labelled(kmers: np.ndarray, text: np.ndarray) -> np.ndarray:
    """K-mers told apart by their occurrence number in their text."""
    if len(kmers) == 0:
        return kmers
    own = tb.mix(kmers + tb.mix(text.astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    ordered = own[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    number = np.arange(len(order)) - first[np.cumsum(new) - 1]
    out = kmers.copy()
    again = number > 0
    out[order[again]] = tb.mix(kmers[order[again]] + number[again].astype(np.uint64) * _LABEL)
    return out


def kmers_of(hashes: np.ndarray, text: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(k-mers in text order, text of each); a text of fewer words has one k-mer."""
    whole = tb.whole_windows(text, size)
    kmers, of = tb.window_hashes(hashes, size)[whole], text[:len(whole)][whole]
    texts, first, count = np.unique(text, return_index=True, return_counts=True)
    short = count < size
    if short.any():
        made = []
        for start, n in zip(first[short].tolist(), count[short].tolist()):
            # the length is mixed in: texts of one word hash and of two such words differ
            with np.errstate(over="ignore"):
                made.append(tb.window_hashes(hashes[start:start + n], n)[0] + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15))
        kmers, of = np.append(kmers, np.array(made, dtype=np.uint64)), np.append(of, texts[short])
        order = np.argsort(of, kind="stable")
        kmers, of = kmers[order], of[order]
    return labelled(kmers, of), of


def sketches(kmers: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have k-mers, their bands)."""
    texts, first, count = np.unique(text, return_index=True, return_counts=True)
    pairs = np.empty((len(_SEEDS), len(texts)), dtype=np.uint64)
    if len(texts) == 0:
        return texts, np.zeros((0, BANDS), dtype=np.int64)
    for j, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS)):
        ranks = (kmers ^ seed) * factor
        least = np.minimum.reduceat(ranks, first)
        place = np.flatnonzero(ranks == np.repeat(least, count))
        ranks[place] = MAX
        second = np.minimum.reduceat(ranks, first)
        after = np.flatnonzero(ranks == np.repeat(second, count))
        if len(after) != len(place):  # texts of one k-mer, or the rank MAX itself
            after = after[np.append(True, np.diff(text[after]) > 0)]
        in_order = place <= after
        pairs[j] = tb.mix(np.where(in_order, least, second) * _PAIR + np.where(in_order, second, least))
    bands = np.empty((len(texts), BANDS), dtype=np.int64)
    for b in range(BANDS):
        value = np.full(len(texts), b, dtype=np.uint64)
        for j in range(b * ORDERS_PER_BAND, (b + 1) * ORDERS_PER_BAND):
            value = tb.mix(value * _PAIR + pairs[j])
        bands[:, b] = value.view(np.int64)
    return texts, bands


def _sketch(batches):
    for batch in tb.pieces(batches, "text"):
        texts = tb.column_of(batch, "text")
        data, offsets = tb.utf8(texts)
        starts, ends, text = tb.words(data, offsets)
        kmers, of = kmers_of(tb.segment_hashes(data, starts, ends), text)
        have, bands = sketches(kmers, of)
        cut = np.zeros(batch.num_rows + 1, dtype=np.int32)
        cut[have + 1] = BANDS
        raw, at, valid = data.tobytes(), offsets.tolist(), texts.is_valid().to_pylist()
        keys = [hashlib.md5(raw[at[i]:at[i + 1]]).digest() if valid[i] else None for i in range(len(valid))]
        yield pa.RecordBatch.from_arrays([
            tb.column_of(batch, "doc_id"), pa.array(keys, pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.cumsum(cut), pa.int32()), pa.array(bands.ravel(), pa.int64())),
        ], names=["doc_id", "key", "bands"])


def _word_hashes(batches):
    for batch in tb.pieces(batches, "text"):
        data, offsets = tb.utf8(tb.column_of(batch, "text"))
        starts, ends, text = tb.words(data, offsets)
        hashes = tb.segment_hashes(data, starts, ends).astype(np.uint32)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        held = [hashes[cut[i]:cut[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [tb.column_of(batch, "key"), pa.array(held, pa.binary())], names=["key", "words"])


def shingle_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the labelled k-mers of two sequences of word hashes."""
    sets = []
    for words in (a, b):
        kmers, _ = kmers_of(words.astype(np.uint64), np.zeros(len(words), dtype=np.int64))
        sets.append(kmers)
    if not len(sets[0]) or not len(sets[1]):
        return float(len(sets[0]) == len(sets[1]))
    if min(map(len, sets)) < SIMILARITY * max(map(len, sets)):
        return min(map(len, sets)) / max(map(len, sets))
    both = len(np.intersect1d(*sets, assume_unique=True))
    return both / (len(sets[0]) + len(sets[1]) - both)


def banded_edits(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Inserted, deleted and replaced words between a and b, or limit + 1 if there are more.

    Follows the furthest point that each diagonal of the band reaches with 0, 1, 2, ... edits.
    """
    n, m = len(a), len(b)
    goal = m - n

    def slide(i: int, k: int) -> int:
        step = 32
        while True:
            size = min(step, n - i, m - i - k)
            if size <= 0:
                return i
            differ = a[i:i + size] != b[i + k:i + k + size]
            at = int(differ.argmax())
            if differ[at]:
                return i + at
            i, step = i + size, step * 4

    if abs(goal) > limit:
        return limit + 1
    reach = {0: slide(0, 0)}
    if reach.get(goal) == n:
        return 0
    for edits in range(1, limit + 1):
        further = {}
        for k in range(-edits, edits + 1):
            if abs(goal - k) > limit - edits:
                continue
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            i = min(i, n, m - k)
            if i >= 0 and i + k >= 0:
                further[k] = slide(i, k)
        if further.get(goal, -1) == n:
            return edits
        reach = further
    return limit + 1


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    if shingle_similarity(a, b) < least:
        return False
    limit = int(np.floor((1 - least) * max(len(a), len(b)) + 1e-9))
    return banded_edits(a, b, limit) <= limit


def _verify(least: float):
    def run(batches):
        for batch in batches:
            left, right = batch.column("words_a"), batch.column("words_b")
            good = [similar(np.frombuffer(left[i].as_buffer(), np.uint32),
                            np.frombuffer(right[i].as_buffer(), np.uint32), least)
                    for i in range(batch.num_rows)]
            linked = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            if linked.num_rows:
                yield linked
    return run


def _words_of(keys: DataFrame, documents: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, words): hashes of the words of the given texts, as a written table."""
    needed = materialise(texts.select("key", "first").join(keys, "key", "left_semi"), "compared-keys")
    keyed = documents.select("doc_id", "text").withColumn("key", F.unhex(F.md5("text")))
    rows = checked_join(keyed, needed, "key", "inner").where(F.col("doc_id").eqNullSafe(F.col("first")))
    return materialise(
        rows.select("key", "text").mapInArrow(_word_hashes, "key binary, words binary")
        .dropDuplicates(["key"]), "compared-words")


def _links(pairs: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of text keys that are similar, as a written table."""
    a = held.select(F.col("key").alias("a"), F.col("words").alias("words_a"))
    b = held.select(F.col("key").alias("b"), F.col("words").alias("words_b"))
    return materialise(
        pairs.join(a, "a").join(b, "b").select("a", "b", "words_a", "words_b")
        .mapInArrow(_verify(least), "a binary, b binary"), "links")


def _kmer_rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            words = np.frombuffer(batch.column("words")[i].as_buffer(), np.uint32).astype(np.uint64)
            kmers, _ = kmers_of(words, np.zeros(len(words), dtype=np.int64))
            n = len(kmers)
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("node")[i].as_py()] * n, pa.int64()), pa.array([n] * n, pa.int32()),
                    pa.array(kmers.view(np.int64))], names=["node", "n", "kmer"])


def _length_class(length):
    return F.floor(F.log(length) / F.log(F.lit(1.05))).cast("int")


def across_components(nodes: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of texts (key, root) with different roots that can have the similarity ``least``.

    Exact: with the k-mers of all texts in one order, rarest first, two sets of that similarity have
    their first common k-mer early in both, and so late at the latest that enough k-mers follow.
    The longer text meets only lengths that this leaves, by classes of length in the join key, so
    texts that share all but too many of their k-mers do not meet at all.
    """
    numbered = materialise(nodes.distinct().withColumn("node", F.monotonically_increasing_id()), "numbered")
    rows = materialise(
        numbered.join(held, "key").select("node", "words").mapInArrow(_kmer_rows, "node long, n int, kmer long"), "kmers")
    shared = rows.groupBy("kmer").agg(F.count("*").alias("texts"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("texts", "kmer"))
    size, at, small = F.col("n"), F.col("at"), F.lit(1e-9)
    ranked = rows.join(shared, "kmer").withColumn("at", rank).where(
        (F.col("texts") > 1) & (at <= size - F.ceil(size * least - small) + 1))
    ranked = materialise(ranked.join(numbered.select("node", "root"), "node").select(
        "node", "root", "n", "at", "kmer"), "rare-kmers")
    index = ranked.where(at <= size - F.ceil(size * (2 * least / (1 + least)) - small) + 1).select(
        *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", "at")], "kmer",
        _length_class(size).alias("length"))
    longest = F.least(size, F.floor((size - at + 1) * ((1 + least) / least) - size + small))
    shortest = F.greatest(F.lit(1), F.ceil(size * least - small))
    probe = ranked.where(longest >= shortest).withColumn(
        "length", F.explode(F.sequence(_length_class(shortest), _length_class(longest))))
    shorter = (F.col("n_b") < size) | ((F.col("n_b") == size) & (F.col("node_b") < F.col("node")))
    enough = F.least(size - at, F.col("n_b") - F.col("at_b")) + 1 >= F.ceil(
        (size + F.col("n_b")) * (least / (1 + least)) - small)
    met = probe.join(index, ["kmer", "length"]).where(
        (F.col("root") != F.col("root_b")) & shorter & enough).select("node", "node_b").distinct()
    x = numbered.select("node", F.col("key").alias("a"))
    y = numbered.select(F.col("node").alias("node_b"), F.col("key").alias("b"))
    return met.join(x, "node").join(y, "node_b").select("a", "b")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, copy_of (least id with this very text), class_id (least id of
    all documents linked to it, directly or through others) and n_links of its text (comparisons
    that found it similar; members of one class need not all be compared)."""
    sketched = materialise(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_sketch, "doc_id long, key binary, bands array<long>"), "sketches")
    texts = materialise(
        sketched.where(F.col("key").isNotNull()).groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.any_value("bands").alias("bands")), "texts")
    members = texts.select("key", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    met = materialise(members.join(sizes, "bucket"), "buckets")
    # the member that meets the most others is the likeliest original of a group of copies
    popular = met.groupBy("key").agg(F.sum("size").alias("met"))
    centre = met.join(popular, "key").groupBy("bucket").agg(F.max(F.struct("met", "key"))["key"].alias("centre"))
    grouped = materialise(met.join(centre, "bucket"), "centred-buckets")
    stars = materialise(grouped.where(F.col("key") != F.col("centre")).select(
        F.col("centre").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
    held = _words_of(
        stars.select(F.col("a").alias("key")).union(stars.select("b")).distinct(), documents, texts)
    links = _links(stars, held, similarity)
    found = components(links)

    # buckets that still hold several components, other than compared pairs
    rooted = grouped.where(F.col("size") > 2).join(
        found.select(F.col("node").alias("key"), "root"), "key", "left").select(
        "bucket", "key", F.coalesce("root", "key").alias("root"))
    open_buckets = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        F.col("low") < F.col("high")).select("bucket")
    left = materialise(
        rooted.join(open_buckets, "bucket", "left_semi").select("key", "root").distinct(), "open-texts")
    if not left.isEmpty():
        pairs = materialise(across_components(left, held, similarity), "pairs")
        links = links.unionByName(_links(pairs, held, similarity))
        found = components(links)

    degree = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(
        F.count("*").alias("n_links"))
    rooted = materialise(
        texts.select("key", "first").join(found.select(F.col("node").alias("key"), "root"), "key", "left")
        .join(degree, "key", "left")
        .select("key", "first", F.coalesce("root", "key").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "rooted")
    classes = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    named = rooted.join(classes, "root").select("key", F.col("first").alias("copy_of"), "class_id", "n_links")
    return sketched.select("doc_id", "key").join(named, "key", "left").select(
        "doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
