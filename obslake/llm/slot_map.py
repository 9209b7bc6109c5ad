"""Sharding by fixed virtual slots; DataFrame functions only.

Records are hashed by their id into thousands of virtual slots, whose number never changes. Bytes are
added up per slot, and a versioned map says which shard owns each slot. The first version deals the
slots, largest first, each to the shard with the fewest bytes so far, so shards differ by no more
than a small slot. A further shard edits the map: it takes slots from the fullest shards until it
has its share, and every other slot stays where it is. Only the map (as many rows as slots) is ever
sorted in one place; records are never moved to compute it.

The law is ``bytes``: sizes of shards near equal. A record is placed by its id alone, so equal texts
may lie in different shards; a group of copies with a third of all rows could not be kept together
and leave the sizes equal.

Within its shard a record has a position: slots lie one after the other, and records of a slot are in
order of id. Positions run from 0 without gaps.

Null text: 0 bytes, checksum 0 (that of no bytes). Null id: hashed by its text instead. Rows with
equal id lie in the same slot, in an order of their texts' checksum and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.session import materialise

SHARDS = 24
SLOTS = 4096
#: Bytes that a record costs besides its text.
OVERHEAD = 8


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of a record: the first 60 bits of the MD5 of its id, modulo the slots."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.coalesce(F.md5(text), F.lit(""))))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def slotted(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot): narrow rows, all that sharding needs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        slot_of(F.col("doc_id"), F.col("text"), slots).alias("virtual_slot"))


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, rows) of every slot, empty ones too."""
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return every.join(sums, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def _sorted(slots: DataFrame, order: Column) -> DataFrame:
    """All slots as one array; there are a fixed number of them."""
    return slots.groupBy().agg(F.array_sort(F.collect_list(order)).alias("slots"))


def _least(loads: Column) -> Column:
    return (F.array_position(loads, F.array_min(loads)) - 1).cast("int")


def _most(loads: Column) -> Column:
    return (F.array_position(loads, F.array_max(loads)) - 1).cast("int")


def first_map(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: (version, virtual_slot, shard, bytes, rows)."""
    entry = F.struct((-F.col("bytes")).alias("minus"), F.col("virtual_slot").alias("slot"), F.col("rows").alias("rows"))
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.lit(None).cast("array<int>").alias("chosen"))

    def deal(state, slot):
        shard = _least(state["loads"])
        loads = F.transform(state["loads"], lambda load, i: F.when(i == shard, load - slot["minus"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(
            F.coalesce(state["chosen"], F.array().cast("array<int>")), F.array(shard)).alias("chosen"))

    dealt = _sorted(sized, entry).select(
        "slots", F.aggregate("slots", start, deal)["chosen"].alias("chosen"))
    each = dealt.select(F.inline(F.arrays_zip("slots", "chosen")))
    return each.select(
        F.lit(1).alias("version"), F.col("slots.slot").alias("virtual_slot"), F.col("chosen").alias("shard"),
        (-F.col("slots.minus")).alias("bytes"), F.col("slots.rows").alias("rows"))


def add_shard(current: DataFrame, shards: int) -> DataFrame:
    """The next version of a map of ``shards`` shards, with one more.

    Slots are offered in an order of hashes; the new shard takes one if its shard is the fullest
    or above the new mean, and the new one does not pass the mean by it. No slot goes elsewhere.
    """
    entry = F.struct(F.xxhash64("virtual_slot").alias("order"), F.col("virtual_slot").alias("slot"),
                     F.col("shard").alias("shard"), F.col("bytes").alias("bytes"), F.col("rows").alias("rows"),
                     F.col("version").alias("version"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards)), lambda s: F.aggregate(
        F.filter("slots", lambda e: e["shard"] == s), F.lit(0).cast("long"), lambda t, e: t + e["bytes"]))
    start = F.struct(F.col("loads").alias("loads"), F.lit(None).cast("array<int>").alias("chosen"))

    def offer(state, slot):
        mean = F.col("mean")
        taken = (F.element_at(state["loads"], slot["shard"] + 1) - slot["bytes"] >= mean) & (
            F.element_at(state["loads"], F.lit(shards + 1)) + slot["bytes"] <= mean)
        shard = F.when(taken, F.lit(shards)).otherwise(slot["shard"])
        moved = F.transform(state["loads"], lambda load, i: load + F.when(
            taken & (i == shards), slot["bytes"]).when(taken & (i == slot["shard"]), -slot["bytes"]).otherwise(0))
        return F.struct(moved.alias("loads"), F.concat(
            F.coalesce(state["chosen"], F.array().cast("array<int>")), F.array(shard)).alias("chosen"))

    held = _sorted(current, entry).withColumn("loads", loads)
    held = held.withColumn("mean", F.aggregate("loads", F.lit(0).cast("long"), lambda t, x: t + x) / (shards + 1))
    dealt = held.select("slots", F.aggregate("slots", start, offer)["chosen"].alias("chosen"))
    each = dealt.select(F.inline(F.arrays_zip("slots", "chosen")))
    return each.select(
        (F.col("slots.version") + 1).alias("version"), F.col("slots.slot").alias("virtual_slot"),
        F.col("chosen").alias("shard"), F.col("slots.bytes").alias("bytes"), F.col("slots.rows").alias("rows"))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map, whose files are a folder per version."""
    slot_map.repartition(1).write.partitionBy("version").mode("append").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """A version of a stored map, the latest by default."""
    held = spark.read.parquet(path)
    if version is None:
        version = held.agg(F.max("version").alias("v")).first()["v"]
    return held.where(F.col("version") == version).select("version", "virtual_slot", "shard", "bytes", "rows")


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and slot, the record's position in its shard, to records with a virtual slot.

    A shard's slots lie one after the other by number, so the position is the rows of its slots
    before, from the map, and the rank within the slot: no shard is sorted as a whole.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("virtual_slot").orderBy(
        F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    ranked = records.withColumn("_rank", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(starts), "virtual_slot").select(
        *records.columns, "shard", (F.col("_start") + F.col("_rank")).alias("slot"))


def assign(documents: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Every document's shard: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot."""
    records = materialise(slotted(documents, slots), "slotted")
    slot_map = materialise(first_map(slot_bytes(records, slots), shards), "slot-map")
    return place(records, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
