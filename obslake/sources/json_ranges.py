"""One large JSON object per file, its entries read in byte ranges on many tasks.

Whether a byte is structure or part of a string depends on every byte before it: on the quotes not
escaped by an odd run of backslashes, and on the depth of braces and brackets outside strings.
So, as for CSV files:

1. Each range reports, for each state it may start in (the first byte escaped or not, inside a string
   or not), the state it ends in and how much it changes the depth.
2. The ranges of a file are walked in order, which gives each its true starting state and depth (one
   small row per range).
3. Each range cuts the entries of the top-level object that begin in it: an entry begins after the
   opening brace or a comma at depth one and ends before the next such comma or the closing brace,
   reading on into later ranges when it is longer. Entries are parsed by Spark (``from_json``).

A file must hold one object and nothing else but white space: a file that is no JSON object, that ends
inside it, holds a second value or an empty entry fails the job; a file of no bytes is skipped, as
Spark's file readers skip it. Entries keep their byte position, so the last of equal keys can win.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.sources.csv_ranges import _open

RANGE_BYTES = 16 << 20
QUOTE, BACKSLASH = 0x22, 0x5C
OPEN, CLOSE, COMMA = (0x7B, 0x5B), (0x7D, 0x5D), 0x2C
SPACE = np.array([0x20, 0x09, 0x0A, 0x0D], dtype=np.uint8)
STATES = [(e, s) for e in (False, True) for s in (False, True)]
STARTS = "source_file string, lo long, hi long, size long, esc boolean, str boolean, depth long, started boolean"
TRANSFER = ", ".join(f"esc{k} boolean, str{k} boolean, delta{k} long" for k in range(4))


def walk(data: bytes, escaped: bool, in_string: bool, depth: int):
    """The bytes of a piece from a known state: (raw bytes, outside-string mask, depth before each byte,
    end state as (escaped, in_string, depth))."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    at = np.arange(n, dtype=np.int64)
    slash = raw == BACKSLASH
    last_other = np.maximum.accumulate(np.where(slash, -1, at)) if n else at
    before_other = np.concatenate([[-1], last_other[:-1]]) if n else at
    run = at - before_other - 1 + np.where(before_other < 0, int(escaped), 0)
    quote = (raw == QUOTE) & (run % 2 == 0)
    flips = np.cumsum(quote, dtype=np.int64)
    inside_before = (np.concatenate([[0], flips[:-1]]) + int(in_string)) % 2 == 1 if n else np.zeros(0, bool)
    outside = ~inside_before & ~quote
    step = np.where(outside & np.isin(raw, OPEN), 1, 0) - np.where(outside & np.isin(raw, CLOSE), 1, 0)
    depth_after = np.cumsum(step, dtype=np.int64) + depth
    depth_before = depth_after - step
    if n:
        tail = n - 1 - int(last_other[-1])
        end = ((tail + (int(escaped) if last_other[-1] < 0 else 0)) % 2 == 1,
               bool((flips[-1] + int(in_string)) % 2), int(depth_after[-1]))
    else:
        end = (escaped, in_string, depth)
    return raw, outside, depth_before, end


def _transfer(batches):
    for batch in batches:
        rows = []
        for uri, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("source_file", "lo", "hi"))):
            with _open(uri) as handle:
                data = handle.read_at(hi - lo, lo)
            row = {"source_file": uri, "lo": lo, "hi": hi,
                   "blank": bool(np.isin(np.frombuffer(data, np.uint8), SPACE).all())}
            for k, (escaped, in_string) in enumerate(STATES):
                end = walk(data, escaped, in_string, 0)[3]
                row |= {f"esc{k}": end[0], f"str{k}": end[1], f"delta{k}": end[2]}
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=_schema(f"source_file string, lo long, hi long, blank boolean, {TRANSFER}"))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _chain(key, table):
    """The true start of each range of one file, walking its ranges in order (one row per range)."""
    table = table.sort_by("lo")
    state, started, out = (False, False, 0), False, []
    for row in table.to_pylist():
        out.append({"source_file": row["source_file"], "lo": row["lo"], "hi": row["hi"], "size": row["size"],
                    "esc": state[0], "str": state[1], "depth": state[2], "started": started})
        k = STATES.index((state[0], state[1]))
        state = (row[f"esc{k}"], row[f"str{k}"], state[2] + row[f"delta{k}"])
        started = started or not row["blank"]
    return pa.Table.from_pylist(out, schema=_schema(STARTS))


def _entries(batches):
    schema = _schema("source_file string, pos long, entry string, problem string")
    for batch in batches:
        rows = []
        names = ("source_file", "lo", "hi", "size", "esc", "str", "depth", "started")
        for uri, lo, hi, size, esc, in_str, depth, started in zip(*(batch.column(c).to_pylist() for c in names)):
            with _open(uri) as handle:
                rows.extend(_entries_of(handle, uri, lo, hi, size, (esc, in_str, depth), started))
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _entries_of(handle, uri, lo, hi, size, state, started):
    raw, outside, depth_before, end = walk(handle.read_at(hi - lo, lo), *state)
    blank = np.isin(raw, SPACE)
    top = outside & (depth_before <= 0)
    opening = np.flatnonzero(top & (raw == OPEN[0]) & (depth_before == 0))
    comma = np.flatnonzero(outside & (raw == COMMA) & (depth_before == 1))
    stray = np.flatnonzero(top & ~blank & ~((raw == OPEN[0]) & (depth_before == 0)))
    # the one opening brace is the first byte of the file that is not white space
    first = np.flatnonzero(~blank)
    fine = len(stray) == 0 and (len(opening) == 0 or (
        len(opening) == 1 and not started and first[0] == opening[0]))
    if hi == size:
        fine = fine and end[2] == 0 and not end[1] and (started or len(first) > 0)
    rows = [] if fine else [{"source_file": uri, "pos": lo, "entry": None, "problem": f"not a JSON object: {uri}"}]
    ends = np.flatnonzero(outside & (depth_before == 1) & ((raw == COMMA) | (raw == CLOSE[0])))
    for s in np.sort(np.concatenate([opening, comma])).tolist():
        k = int(np.searchsorted(ends, s + 1))
        if k < len(ends):
            stop, kind = int(ends[k]), "closing" if raw[ends[k]] == CLOSE[0] else "comma"
        else:
            stop, kind = _read_on(handle, lo + len(raw), size, end)
            stop -= lo
        text = raw[s + 1:stop].tobytes() if stop <= len(raw) else handle.read_at(stop - s - 1, lo + s + 1)
        body = text.decode("utf-8", errors="replace")
        if body.strip(" \t\r\n"):
            rows.append({"source_file": uri, "pos": lo + s + 1, "entry": body, "problem": None})
        elif not (raw[s] == OPEN[0] and kind == "closing"):
            rows.append({"source_file": uri, "pos": lo + s + 1, "entry": None,
                         "problem": f"not a JSON object: {uri} (an empty entry at byte {lo + s + 1})"})
    return rows


def _read_on(handle, offset: int, size: int, state) -> tuple[int, str]:
    """(file offset of the next comma or closing brace at depth one from ``offset`` on, which of them)."""
    piece = RANGE_BYTES
    while offset < size:
        more = handle.read_at(min(piece, size - offset), offset)
        r, o, d, state = walk(more, *state)
        found = np.flatnonzero(o & (d == 1) & ((r == COMMA) | (r == CLOSE[0])))
        if len(found):
            return offset + int(found[0]), "closing" if r[int(found[0])] == CLOSE[0] else "comma"
        offset += len(more)
    return size, "end"


def object_entries(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, pos, key, value): every entry of the object in each file, value as JSON text."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("length").alias("size"))
    count = F.greatest(F.ceil(F.col("size") / F.lit(range_bytes)), F.lit(1)).cast("long")
    ranges = files.select("source_file", "size", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("k"))
    ranges = ranges.select(
        "source_file", "size", (F.col("k") * range_bytes).alias("lo"),
        F.least((F.col("k") + 1) * range_bytes, F.col("size")).alias("hi"))
    cores = spark.sparkContext.defaultParallelism
    moves = ranges.repartition(cores).mapInArrow(
        _transfer, f"source_file string, lo long, hi long, blank boolean, {TRANSFER}")
    moves = moves.join(ranges.select("source_file", "lo", "size"), ["source_file", "lo"])
    starts = moves.groupBy("source_file").applyInArrow(_chain, STARTS)
    entries = starts.repartition(cores).mapInArrow(_entries, "source_file string, pos long, entry string, problem string")
    failed = F.raise_error(F.col("problem"))
    entries = entries.select("source_file", "pos", F.when(F.col("problem").isNotNull(), failed)
                             .otherwise(F.col("entry")).alias("entry")).filter(F.col("entry").isNotNull())
    one = F.from_json(F.concat(F.lit("{"), F.col("entry"), F.lit("}")), "map<string,string>")
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("source_file")))
    pairs = entries.select("source_file", "pos", F.when(one.isNull() | (F.size(one) != 1), broken)
                           .otherwise(one).alias("m"))
    return pairs.select("source_file", "pos", F.map_keys("m")[0].alias("key"), F.map_values("m")[0].alias("value"))
