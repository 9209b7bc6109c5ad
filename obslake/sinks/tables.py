"""Writing tables. Every write replaces what was there, so a rerun leaves one copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.schemas import EMBEDDINGS, conform
from obslake.sources.tables import TABLE_SCHEMAS

PARTITION_COLUMNS = {"dim_article": "published_year"}


def write_table(df: DataFrame, root: str, name: str) -> None:
    """Typed Parquet table, columns matched by name.

    A partitioned table is rebalanced on its partition column first: rows of one value meet in
    few files, and a value that holds much of the table is spread over several tasks.
    """
    if name in TABLE_SCHEMAS:
        df = conform(df, TABLE_SCHEMAS[name])
    target = f"{root.rstrip('/')}/{name}"
    partition = PARTITION_COLUMNS.get(name)
    if partition:
        df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 64) -> None:
    """Catalog table; bucketed by a join key, later joins on that key need no shuffle."""
    writer = conform(df, TABLE_SCHEMAS[name]).write.mode("overwrite").format("parquet")
    if name in PARTITION_COLUMNS:
        writer = writer.partitionBy(PARTITION_COLUMNS[name])
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def write_embeddings(df: DataFrame, root: str) -> None:
    write_table(conform(df, EMBEDDINGS), root, "embeddings")


def csv_ready(df: DataFrame) -> DataFrame:
    """Arrays as JSON text; CSV has no nested values."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, root: str, name: str) -> None:
    csv_ready(df).write.mode("overwrite").options(
        header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    ).csv(f"{root.rstrip('/')}/{name}")
