"""Incremental ingest: new CSV files -> cleaned rows, upserted by article id.

Each micro-batch cleans its rows with the batch functions and writes one folder of a change log,
named after the batch, so a replayed batch overwrites itself. The current state is the newest row
per article over a base table and the changes after it. Compaction writes that state as a new base
version and then records the version, so a reader never sees a half-written base.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from obslake.operators.lookup import lookup_join
from obslake.operators.series import latest_observation
from obslake.plans.silver import clean_articles
from obslake.rules import DEFAULT_RULES, Rules
from obslake.schemas import RAW_ARTICLES, SILVER_ARTICLES
from obslake.session import materialise
from obslake.sources.files import SURPLUS, checked_cells, csv_options

CLEANED = T.StructType(SILVER_ARTICLES.fields + [
    T.StructField("published_date_raw", T.StringType()),
    T.StructField("date_parse_status", T.StringType()),
])
CHANGES = T.StructType(CLEANED.fields + [T.StructField("batch_id", T.LongType())])
VERSIONS = T.StructType([T.StructField("version", T.LongType())])


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows in tasks of the advisory size, whatever the tasks or keys they come from."""
    return rows.withColumn("_deal", F.monotonically_increasing_id()).hint("rebalance", "_deal").drop("_deal")


def append_batch(
    batch: DataFrame, batch_id: int, companies: DataFrame, root: str,
    rules: Rules = DEFAULT_RULES,
) -> None:
    """Clean one micro-batch and write its change folder, one row per article.

    When a batch holds an article more than once, the newest file wins, then the last row by
    content, so a replay picks the same one. A file is one task however large it is, so its rows are
    dealt out before they are sorted.
    """
    order = F.struct("file_time", "source_file", F.to_json(F.struct(*RAW_ARTICLES.names)))
    newest = materialise(latest_observation(
        dealt(batch).withColumn("_order", order), ["article_id"], "_order", "source_file"), "batch")
    cleaned = clean_articles(newest, companies, rules)
    cleaned.write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")


def start_ingest(
    spark: SparkSession, source: str, companies: DataFrame, root: str,
    rules: Rules = DEFAULT_RULES, multi_line: bool = True, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process the files that have arrived since the last run, then stop.

    A row with values beyond the last column fails the run, and its batch is not written.
    """
    names = RAW_ARTICLES.names
    source_file = F.col("_metadata.file_path")
    # as in scan_articles, a row that does not have a cell per column is also kept as text
    schema = T.StructType([*RAW_ARTICLES.fields, T.StructField(SURPLUS, T.StringType())])
    stream = (
        spark.readStream.schema(schema)
        .options(**csv_options(multi_line), columnNameOfCorruptRecord=SURPLUS, columnPruning=False)
        .option("maxFilesPerTrigger", files_per_batch).csv(source)
        .select(*[cell.alias(c) for c, cell in zip(names, checked_cells(names, source_file))],
                source_file.alias("source_file"),
                F.col("_metadata.file_modification_time").alias("file_time"))
    )
    return (
        stream.writeStream
        .foreachBatch(lambda df, batch_id: append_batch(df, batch_id, companies, root, rules))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )


def _current_version(spark: SparkSession, root: str) -> int:
    versions = _read_or_empty(spark, f"{root}/versions", VERSIONS)
    return versions.agg(F.coalesce(F.max("version"), F.lit(-1)).alias("v")).first()["v"]


def current_articles(spark: SparkSession, root: str) -> DataFrame:
    """Cleaned articles as of the last batch, one row per article.

    The base is already unique: only the rows that changed since are removed from it, by a join
    that leaves it in place when the changed ids are few.
    """
    version = _current_version(spark, root)
    log = _read_or_empty(spark, f"{root}/changes", CHANGES).where(F.col("batch_id") > version)
    changed = latest_observation(log, ["article_id"], "batch_id", "article_id")
    if version < 0:
        return changed
    base = spark.read.schema(CHANGES).parquet(f"{root}/base/version={version}")
    kept = lookup_join(base, log.select("article_id").distinct(), "article_id", "left_anti")
    return kept.select(*CHANGES.names).unionByName(changed.select(*CHANGES.names))


def compact(spark: SparkSession, root: str) -> int:
    """Fold the change log into a new base version and return its number."""
    last = _read_or_empty(spark, f"{root}/changes", CHANGES).agg(F.max("batch_id").alias("v")).first()
    if last["v"] is None or last["v"] == _current_version(spark, root):
        return _current_version(spark, root)
    version = last["v"]
    state = current_articles(spark, root).where(F.col("batch_id") <= version)
    state.write.mode("overwrite").parquet(f"{root}/base/version={version}")
    spark.createDataFrame([(version,)], VERSIONS).coalesce(1).write.mode("append").parquet(
        f"{root}/versions")
    return version
