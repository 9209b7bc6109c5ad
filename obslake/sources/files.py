"""Raw file sources with provenance."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.company import lenient_boolean, lenient_long
from obslake.functions.text import fold_null_tokens
from obslake.operators.lookup import lookup_join
from obslake.sources.csv_ranges import RANGE_BYTES, csv_records
from obslake.sources.json_ranges import RANGE_BYTES as JSON_RANGE_BYTES
from obslake.sources.json_ranges import object_entries
from obslake.schemas import BRONZE_COMPANIES, conform
from obslake.session import materialise

HASHED_AT_A_TIME = 1 << 20
SURPLUS = "_surplus"
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
BYTE_ORDER_MARK = "\ufeff"

COMPANY_FIELDS = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("founded_year", "headquarters", "employee_count", "industry", "is_public",
                 "stock_ticker")
])


def csv_options(multi_line: bool) -> dict[str, object]:
    return {
        "header": True, "multiLine": multi_line, "quote": '"', "escape": '"',
        "enforceSchema": False, "encoding": "UTF-8",
    }


def scan_articles(
    spark: SparkSession, path: str, multi_line: bool = True, range_bytes: int | None = RANGE_BYTES,
) -> DataFrame:
    """All columns of a CSV file or folder as text, with "no value" spellings as ''.

    Column names come from the header line and are stripped; every file must have the same
    header. Missing cells at the end of a row are empty; a row with values beyond the last column
    fails the job. With ``multi_line`` a quoted cell may hold line breaks; files are then read in
    byte ranges of ``range_bytes`` on as many tasks, cut at true record borders (``None``: each file
    is one task of Spark's whole-file reader). Without it Spark splits large files by lines.
    """
    names = spark.read.options(**csv_options(multi_line)).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if multi_line and range_bytes:
        ddl = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in [*names, SURPLUS])
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": SURPLUS}
        records = csv_records(spark, path, range_bytes).select(
            F.from_csv("record", ddl, options).alias("r"), "source_file", "header")
        # every file's header names the same columns in the same order, as the whole-file reader demands
        # (an empty name is one that Spark calls _c and its place)
        fits = [F.coalesce(F.col("r").getField(c), F.lit("")) == F.lit("" if c == f"_c{i}" else c)
                for i, c in enumerate(names)]
        same = F.col(f"r.{SURPLUS}").isNull() & ~F.array_contains(F.array(*fits), False)
        refused = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema of the first file: "),
                                         F.col("source_file")))
        raw = records.filter(~F.col("header") | F.when(same, F.lit(False)).otherwise(refused)).select(
            *[F.col("r").getField(c).alias(c) for c in [*names, SURPLUS]], "source_file")
    else:
        # a row that does not have a cell per column is also kept as text
        raw = spark.read.schema(text.add(SURPLUS, "string")).options(
            **csv_options(multi_line), columnNameOfCorruptRecord=SURPLUS, columnPruning=False).csv(path).select(
            "*", F.col("_metadata.file_path").alias("source_file"))
    cells = [
        cell.alias(c.lstrip(BYTE_ORDER_MARK).strip()) for c, cell in zip(names, checked_cells(names, F.col("source_file")))]
    return raw.select(*cells, "source_file")


def checked_cells(names: list[str], source_file: Column) -> list[Column]:
    """The cells of a row with "no value" spellings as ''; a row with values beyond the last one fails."""
    surplus = too_many_cells(F.col(SURPLUS), len(names))
    message = F.concat(F.lit("too many cells in "), source_file, F.lit(": "), F.col(SURPLUS))
    return [F.when(surplus, F.raise_error(message)).otherwise(fold_null_tokens(F.col(f"`{c}`"))) for c in names]


def too_many_cells(record: Column, count: int) -> Column:
    """Whether a row kept as text has a value beyond its columns; missing cells are no error."""
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(2 * count + 1)])
    cells = F.from_csv(record, wide.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                       {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    beyond = [cells[f"c{i}"].isNotNull() for i in range(count, 2 * count + 1)]
    # cells after these, of any number: quoted ones are replaced, so that every comma left is a border
    bare = F.split(F.regexp_replace(record, QUOTED, "$1q"), ",", -1)
    rest = F.exists(F.slice(bare, 2 * count + 2, F.size(bare)), lambda cell: F.trim(cell) != "")
    return record.isNotNull() & (F.array_contains(F.array(*beyond), True) | rest)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, source_hash): SHA-1 of each file's bytes."""
    # only the names are read here; a task opens each file and hashes it block by block
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("source_file"), "length")
    return files.select("source_file").mapInArrow(_hash_files, "source_file string, source_hash string")


def _hash_files(batches):
    for batch in batches:
        digests = []
        for uri in batch.column("source_file").to_pylist():
            store, place = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            digest = hashlib.sha1()
            with store.open_input_stream(place) as stream:
                while block := stream.read(HASHED_AT_A_TIME):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("source_file"), pa.array(digests, pa.string())], names=["source_file", "source_hash"])


def with_provenance(rows: DataFrame, path: str) -> DataFrame:
    """Add the file's hash and the time of the run to rows that carry ``source_file``."""
    # kept as a table: hashing reads every file, and the join looks at the hashes more than once
    hashes = materialise(file_hashes(rows.sparkSession, path), "file-hashes")
    return lookup_join(rows, hashes, "source_file").select(
        *[c for c in rows.columns if c != "source_file"],
        "source_file", "source_hash", F.current_timestamp().alias("ingested_at"))


def scan_companies(spark: SparkSession, path: str, range_bytes: int = JSON_RANGE_BYTES) -> DataFrame:
    """One row per key of a JSON object of objects; missing or unreadable fields are NULL.

    A file is read in byte ranges of ``range_bytes`` on as many tasks, cut between the entries of its
    object; larger master data may also come as a folder of such files. Of entries with the same key
    the last one counts: within a file by position, across files by the file's name. A file that is
    no JSON object fails the job.
    """
    entries = object_entries(spark, path, range_bytes)
    # each entry by itself, so that one bad entry leaves its neighbours alone
    parsed = entries.select(
        F.col("key").alias("company_name"), "source_file", "pos", F.from_json("value", COMPANY_FIELDS).alias("f"))
    last = parsed.groupBy("company_name").agg(
        F.max_by(F.struct("f", "source_file"), F.struct("source_file", "pos")).alias("e"))
    return last.select(
        "company_name",
        lenient_long(F.col("e.f.founded_year")).alias("founded_year"),
        F.col("e.f.headquarters").alias("headquarters"),
        lenient_long(F.col("e.f.employee_count")).alias("employee_count"),
        F.col("e.f.industry").alias("industry"),
        lenient_boolean(F.col("e.f.is_public")).alias("is_public"),
        F.col("e.f.stock_ticker").alias("stock_ticker"),
        F.col("e.source_file").alias("source_file"),
    )


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """bronze_articles."""
    return with_provenance(scan_articles(spark, path, multi_line), path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """bronze_companies."""
    return conform(with_provenance(scan_companies(spark, path), path), BRONZE_COMPANIES)
