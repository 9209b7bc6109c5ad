"""Large CSV files whose quoted cells hold line breaks, read in byte ranges on many tasks.

A line break ends a record only outside quotes, and whether a byte is inside quotes depends on every
quote before it in the file. With the escape ``""`` each quote flips the state, so the state before a
byte is the parity of the quotes before it. So:

1. Each range of ``range_bytes`` reports the parity of its quotes and its first line break for either
   state it may start in (first at an even and first at an odd count of its own quotes).
2. A running sum of the parities over the ranges of a file, in order, gives each range its true start
   state, hence its first true record border. A range without one lies inside a record.
3. Each range parses the records that begin after its first border and end at the next range's first
   border (or the file's end), so every record is read by exactly one task, and a record longer than a
   range is read whole by the range it begins in. Either step goes through its range in blocks of
   ``BLOCK_BYTES``, so a task's memory follows neither the range nor the file. The first record of a file is marked as its header.

Records are parsed by Spark's own CSV parser (``from_csv``) with the options of the whole-file reader.
Empty records (blank lines) are skipped as that reader does; a trailing carriage return is dropped.
As that reader does, a file whose first line ends in CR LF has CR LF inside quoted cells read as LF.
Borders follow the quote parity of RFC 4180; a cell that is only an escaped quote (four quote marks)
is one that Spark's whole-file reader itself misreads, continuing the cell over the next line.
Files are opened in the tasks through the file systems of pyarrow (local, HDFS, object stores).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 64 << 20
# a task holds one block of its range and the record that is open at the block's end
BLOCK_BYTES = 4 << 20
QUOTE, BREAK = 0x22, 0x0A
RECORDS_AT_A_TIME = 10_000
SCANNED = "source_file string, lo long, hi long, parity int, first_even long, first_odd long, crlf boolean"
RECORDS = "source_file string, begin long, header boolean, record string"


def _open(uri: str):
    store, place = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return store.open_input_file(place)


def _borders(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(offsets of line breaks, count of quotes before each, quotes in all) of a piece of a file."""
    raw = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(raw == QUOTE)
    breaks = np.flatnonzero(raw == BREAK)
    return breaks, np.searchsorted(quotes, breaks), len(quotes)


def _blocks(handle, begin: int, end: int):
    """The bytes from begin to end, a block at a time."""
    while begin < end and (data := handle.read_at(min(BLOCK_BYTES, end - begin), begin)):
        yield data
        begin += len(data)


def _first_line_crlf(handle) -> bool:
    """Whether the file's first line, which may end in any later range, ends in CR LF."""
    last = 0
    for data in _blocks(handle, 0, handle.size()):
        found = data.find(b"\n")
        if found >= 0:
            return (data[found - 1] if found else last) == 0x0D
        last = data[-1]
    return False


def _scan(batches):
    for batch in batches:
        out = {k: [] for k in ("source_file", "lo", "hi", "parity", "first_even", "first_odd", "crlf")}
        for uri, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("source_file", "lo", "hi"))):
            total, at, first = 0, lo, [None, None]
            with _open(uri) as handle:
                for data in _blocks(handle, lo, hi):
                    breaks, before, quotes = _borders(data)
                    for odd in (0, 1):
                        if first[odd] is None:
                            found = np.flatnonzero((before + total) % 2 == odd)
                            first[odd] = at + int(breaks[found[0]]) if len(found) else None
                    total, at = total + quotes, at + len(data)
                crlf = lo == 0 and _first_line_crlf(handle)
            out["source_file"].append(uri)
            out["lo"].append(lo)
            out["hi"].append(hi)
            out["parity"].append(total % 2)
            out["first_even"].append(first[0])
            out["first_odd"].append(first[1])
            out["crlf"].append(crlf)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("source_file", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("parity", pa.int32()),
            ("first_even", pa.int64()), ("first_odd", pa.int64()), ("crlf", pa.bool_())]))


def _pieces(handle, begin: int, end: int):
    """The bytes between the true borders from begin, which is outside quotes, to end."""
    total, kept = 0, []
    for data in _blocks(handle, begin, end):
        breaks, before, quotes = _borders(data)
        start = 0
        for cut in breaks[(before + total) % 2 == 0].tolist():
            kept.append(data[start:cut])
            yield b"".join(kept)
            start, kept = cut + 1, []
        kept.append(data[start:])
        total += quotes
    yield b"".join(kept)


def _records(batches):
    schema = pa.schema([("source_file", pa.string()), ("begin", pa.int64()), ("header", pa.bool_()),
                        ("record", pa.string())])

    def batch_of(uri, begin, texts, first):
        heads = [first and k == 0 for k in range(len(texts))]
        return pa.RecordBatch.from_pydict(
            {"source_file": [uri] * len(texts), "begin": [begin] * len(texts), "header": heads, "record": texts},
            schema)

    for batch in batches:
        columns = ("source_file", "begin", "end", "crlf")
        for uri, begin, end, crlf in zip(*(batch.column(c).to_pylist() for c in columns)):
            with _open(uri) as handle:
                texts, held, first = [], 0, begin == 0
                for piece in _pieces(handle, begin, end):
                    if piece.endswith(b"\r"):
                        piece = piece[:-1]
                    if piece:
                        piece = piece.replace(b"\r\n", b"\n") if crlf else piece
                        texts.append(piece.decode("utf-8", errors="replace"))
                        held += len(piece)
                    if len(texts) >= RECORDS_AT_A_TIME or held >= BLOCK_BYTES:
                        yield batch_of(uri, begin, texts, first)
                        texts, held, first = [], 0, False
            if texts:
                yield batch_of(uri, begin, texts, first)


def record_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, begin, end, crlf): the byte ranges whose records one task parses; begin 0 holds the
    header; crlf: the file's first line ends in CR LF."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("source_file"), "length")
    count = F.greatest(F.ceil(F.col("length") / F.lit(range_bytes)), F.lit(1)).cast("long")
    ranges = files.select("source_file", "length", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("k"))
    ranges = ranges.select(
        "source_file", (F.col("k") * range_bytes).alias("lo"),
        F.least((F.col("k") + 1) * range_bytes, F.col("length")).alias("hi"))
    # one row per range: deal them out, or all ranges of a file would be scanned by the task that listed it
    ranges = ranges.repartition(spark.sparkContext.defaultParallelism)
    scanned = ranges.mapInArrow(_scan, SCANNED)
    in_file = Window.partitionBy("source_file").orderBy("lo")
    state = F.coalesce(F.sum("parity").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    cut = scanned.select("source_file", "lo", "hi", F.when(state == 0, F.col("first_even"))
                         .otherwise(F.col("first_odd")).alias("cut"),
                         F.first("crlf").over(in_file.rowsBetween(Window.unboundedPreceding, 0)).alias("crlf"))
    following = F.first("cut", ignorenulls=True).over(in_file.rowsBetween(1, Window.unboundedFollowing))
    last = F.max("hi").over(Window.partitionBy("source_file"))
    bounds = cut.select(
        "source_file",
        F.when(F.col("lo") == 0, F.lit(0).cast("long")).otherwise(F.col("cut") + 1).alias("begin"),
        F.coalesce(following + 1, last).alias("end"), "crlf")
    return bounds.filter(F.col("begin").isNotNull() & (F.col("begin") < F.col("end")))


def csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, begin, header, record): every record of the CSV files as its text; the first
    non-empty record of each file is its header."""
    bounds = record_ranges(spark, path, range_bytes)
    return bounds.repartition(bounds.sparkSession.sparkContext.defaultParallelism).mapInArrow(_records, RECORDS)
