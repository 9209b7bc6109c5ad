"""Benchmark decontamination by templates; DataFrame functions only.

A text is cut into numbers and words. A number becomes ``<num>``, a word with a capital letter
``<name>``, a unit after a number ``<unit>``; other words stay. Windows of eight template tokens of
the documents meet those of the benchmark in a join on their hashes, which finds questions whose
numbers, names and units were exchanged.

Windows of one document and one item at the same distance are aligned. An alignment is a leak if it
covers half of the item's windows or 13 tokens (6 windows), and its slots are consistent: over the
aligned slots of a type, equal values of the item stand against equal values of the document and
different ones against different ones. A copy is consistent by nature.

Windows with fewer than four literal tokens match too much and are not used. An item with fewer
than eight tokens, or with null text, has no window and is never reported. Documents with null or
short texts have none either. Null ids are reported as null. Rows that agree in doc_id and text are
reported once. Other columns are ignored.

Templates miss verbatim text where a document has other capitals than the item, where an item is dense
in slots, and where it is short. ``find_copies`` finds these: 13 consecutive tokens of an item, or all
tokens of a shorter one, in a document, whatever the case. Windows of the lengths that the benchmark has
meet in a join on hashes, and the tokens of each hit are compared. An item without tokens is never reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.tables import checked_join
from obslake.session import materialise

WINDOW = 8
LITERALS = 4
SHARE = 0.5
ENOUGH = 6
#: Consecutive tokens of a copy.
COPIED = 13
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+"
#: Units that follow a number.
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg t ton tons tonnes lb lbs "
    "pound pounds ounce ounces oz ml cl l liter liters litre litres gallon gallons second seconds s "
    "minute minutes min hour hours h day days week weeks month months year years dollar dollars euro "
    "euros cent cents usd eur percent degree degrees mph kmh hz khz mhz ghz w kw mw v a ohm j kj cal "
    "kcal bytes kb mb gb tb").split()
NUM, NAME, UNIT = 1, 2, 3


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _slot_or(raw: Column, word: Column, i: Column, literal: Column, kind: str) -> Column:
    """Type of the slot that a token is, or what a literal is to give."""
    number = word < F.lit(":")  # of all tokens only numbers begin below a letter
    after_number = (i > 0) & (F.get(raw, i - 1) < F.lit(":"))
    lower = F.lower(word)
    slot = [F.lit(k).cast(kind) for k in (NUM, UNIT, NAME)]
    return (F.when(number, slot[0]).when(after_number & lower.isin(*UNITS), slot[1])
            .when(lower != word, slot[2]).otherwise(literal))


def kinds(raw: Column) -> Column:
    return F.transform(raw, lambda word, i: _slot_or(raw, word, i, F.lit(0), "int"))


def template(raw: Column) -> Column:
    """One hash per token; a slot has its type instead."""
    def hashed(word, i):
        return _slot_or(raw, word, i, F.xxhash64(word), "long")
    return F.transform(raw, hashed)


def windows(hashes: Column) -> Column:
    """Hash of every eight consecutive tokens."""
    count = F.size(hashes) - F.lit(WINDOW)
    starts = F.when(count >= 0, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, h, ipos, item_windows) of the different windows with enough literals."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("raw")).distinct()
    # written, or the optimizer would put the whole template into the function of each window
    made = materialise(items.select("item_id", template(F.col("raw")).alias("hashes")), "benchmark-templates")
    literals = F.transform(windows(F.col("hashes")), lambda h, i: F.struct(h.alias("h"), i.alias("ipos"), F.size(
        F.filter(F.slice("hashes", i + 1, F.lit(WINDOW)), lambda t: ~t.isin(NUM, NAME, UNIT))).alias("literals")))
    spread = made.select("item_id", F.inline(literals)).where(F.col("literals") >= LITERALS)
    # of equal windows of an item the first: repeated ones must not meet all repeated ones of a text
    spread = spread.groupBy("item_id", "h").agg(F.min("ipos").alias("ipos"))
    total = spread.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    s, t = spread.alias("s"), total.alias("t")
    return s.join(t, F.col("s.item_id").eqNullSafe(F.col("t.item_id"))).select(
        "s.item_id", "s.ipos", "s.h", "t.item_windows")


def _bijective(pairs: Column) -> Column:
    """Whether equal values stand against equal ones and different against different ones."""
    both = F.size(F.array_distinct(pairs))
    return (both == F.size(F.array_distinct(F.transform(pairs, lambda p: p["x"])))) & (
        both == F.size(F.array_distinct(F.transform(pairs, lambda p: p["y"]))))


def _of_kind(kind: int) -> Column:
    return F.filter("slots", lambda p: p["kx"] == kind)


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, exact): every leak of an item in a document.

    ``exact`` tells whether the slots hold the item's own values; n_windows counts the windows of
    the longest alignment.
    """
    key = F.xxhash64("text").alias("_tk")
    items = materialise(benchmark_windows(benchmark), "benchmark-windows")
    hashes = materialise(items.select("h").distinct(), "benchmark-hashes")
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    spread = source.select("doc_id", key, tokens(F.col("text")).alias("raw")).select(
        "doc_id", "_tk", template(F.col("raw")).alias("hashes")).select(
        "doc_id", "_tk", F.posexplode(windows(F.col("hashes"))).alias("pos", "h"))
    hits = materialise(checked_join(spread, hashes, "h", "left_semi", row_bytes=40), "template-hits")

    aligned = hits.distinct().join(items, "h").groupBy(
        "doc_id", "_tk", "item_id", (F.col("pos") - F.col("ipos")).alias("shift")).agg(
        F.count("*").alias("n_windows"), F.min("ipos").alias("low"), F.max("ipos").alias("high"),
        F.max("item_windows").alias("item_windows"))
    aligned = materialise(aligned.where(
        (F.col("n_windows") >= F.col("item_windows") * SHARE) | (F.col("n_windows") >= ENOUGH)), "alignments")

    # the tokens themselves, of the few documents and items concerned
    concerned = materialise(aligned.select(F.col("doc_id").alias("_d"), "_tk").distinct(), "aligned-documents")
    texts = checked_join(source.withColumn("_tk", F.xxhash64("text")), concerned, "_tk", "inner").where(
        F.col("doc_id").eqNullSafe(F.col("_d"))).dropDuplicates(["doc_id", "_tk"]).select(
        "doc_id", "_tk", tokens(F.col("text")).alias("raw"))
    item_texts = benchmark.select("item_id", tokens(F.col("text")).alias("item_raw")).distinct()
    a, d, i = aligned.alias("a"), texts.alias("d"), item_texts.alias("i")
    joined = a.join(d, F.col("a.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("a._tk") == F.col("d._tk"))).join(
        i, F.col("a.item_id").eqNullSafe(F.col("i.item_id"))).select("a.*", "d.raw", "i.item_raw")
    joined = materialise(joined.withColumns({
        "item_kinds": kinds(F.col("item_raw")), "raw_kinds": kinds(F.col("raw"))}), "aligned-tokens")
    places = F.sequence(F.col("low"), F.least(F.col("high") + WINDOW - 1, F.size("item_raw") - 1))
    pair = F.transform(places, lambda p: F.struct(
        F.get("item_raw", p).alias("x"), F.get("raw", p + F.col("shift")).alias("y"),
        F.get("item_kinds", p).alias("kx"), F.get("raw_kinds", p + F.col("shift")).alias("ky")))
    slots = F.filter(pair, lambda p: (p["kx"] == p["ky"]) & (p["kx"] > 0))
    good = F.lit(True)
    for kind in (NUM, NAME, UNIT):
        good = good & _bijective(_of_kind(kind))
    judged = joined.select(
        "doc_id", "item_id", "n_windows", "item_windows", slots.alias("slots")).select(
        "doc_id", "item_id", "n_windows", "item_windows", good.alias("consistent"),
        F.forall("slots", lambda p: p["x"] == p["y"]).alias("exact"))
    best = judged.where("consistent").groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_windows", "exact", "item_windows")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.item_windows", "best.exact")


def _folded(text: Column) -> Column:
    return tokens(F.lower(text))


def _windows_of(length: int) -> Column:
    """(n, pos, h) of every ``length`` consecutive ones of ``hashes``."""
    count = F.size("hashes") - F.lit(length)
    starts = F.when(count >= 0, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        F.lit(length).alias("n"), i.alias("pos"),
        F.xxhash64(F.lit(length), *[F.get("hashes", i + k) for k in range(length)]).alias("h")))


def find_copies(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows): items of which 13 tokens, or all, stand in a document.

    n_windows counts the item's different windows of its longest alignment, whatever the case.
    """
    items = materialise(
        benchmark.select("item_id", _folded(F.col("text")).alias("item_raw")).distinct()
        .where(F.size("item_raw") > 0).select(
            "item_id", "item_raw", F.xxhash64("item_raw").alias("_ik"), F.least(F.size("item_raw"), F.lit(COPIED)).alias("n"),
            F.transform("item_raw", lambda w: F.xxhash64(w)).alias("hashes")), "benchmark-tokens")
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # at most 13
    spread = [items.where(F.col("n") == n).select("item_id", "_ik", F.inline(_windows_of(n))) for n in lengths]
    none = items.limit(0).select("item_id", "_ik", "n", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h"))
    for more in spread:
        none = none.unionByName(more)
    # of equal windows of an item the first, as above
    wanted = none.groupBy("item_id", "_ik", "n", "h").agg(F.min("pos").alias("ipos"))
    total = wanted.groupBy("item_id", "_ik").agg(F.count("*").alias("item_windows"))
    w, t = wanted.alias("w"), total.alias("t")
    wanted = materialise(w.join(t, F.col("w.item_id").eqNullSafe(F.col("t.item_id")) & (F.col("w._ik") == F.col("t._ik"))).select(
        "w.*", "t.item_windows"), "benchmark-copies")
    hashes = materialise(wanted.select("h").distinct(), "copy-hashes")

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    source = source.withColumn("_tk", F.xxhash64("text"))
    hashed = source.select("doc_id", "_tk", F.transform(_folded(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    every = F.concat(*[_windows_of(n) for n in lengths]) if lengths else F.array().cast("array<struct<n:int,pos:int,h:bigint>>")
    hits = checked_join(hashed.select("doc_id", "_tk", F.inline(every)), hashes, "h", "left_semi", row_bytes=40)
    hits = materialise(hits, "copy-hits")

    aligned = materialise(hits.distinct().join(wanted, ["n", "h"]).groupBy(
        "doc_id", "_tk", "item_id", "_ik", "n", (F.col("pos") - F.col("ipos")).alias("shift")).agg(
        F.collect_list("ipos").alias("places"), F.max("item_windows").alias("item_windows")), "copy-alignments")
    concerned = materialise(aligned.select(F.col("doc_id").alias("_d"), "_tk").distinct(), "copy-documents")
    texts = checked_join(source, concerned, "_tk", "inner").where(
        F.col("doc_id").eqNullSafe(F.col("_d"))).dropDuplicates(["doc_id", "_tk"]).select(
        "doc_id", "_tk", _folded(F.col("text")).alias("raw"))
    a, d, i = aligned.alias("a"), texts.alias("d"), items.alias("i")
    joined = a.join(d, F.col("a.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("a._tk") == F.col("d._tk"))).join(
        i, F.col("a.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("a._ik") == F.col("i._ik"))).select(
        "a.*", "d.raw", "i.item_raw")
    same = F.filter("places", lambda p: F.slice("item_raw", p + 1, F.col("n")) == F.slice(
        "raw", p + F.col("shift") + 1, F.col("n")))
    judged = materialise(joined, "copy-tokens").select(
        "doc_id", "item_id", "item_windows", F.size(same).cast("long").alias("n_windows")).where("n_windows > 0")
    best = judged.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_windows", "item_windows")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.item_windows")
