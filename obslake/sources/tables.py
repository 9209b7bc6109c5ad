"""Stored tables: reading them back and querying them by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obslake import schemas

TABLE_SCHEMAS = {
    "silver_articles": schemas.SILVER_ARTICLES,
    "dim_company": schemas.DIM_COMPANY,
    "dim_article": schemas.DIM_ARTICLE_EMBEDDED,
    "fact_arr_observation": schemas.FACT_ARR_OBSERVATION,
    "parse_errors": schemas.PARSE_ERRORS,
    "unmatched_companies": schemas.UNMATCHED_COMPANIES,
    "embeddings": schemas.EMBEDDINGS,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table written by ``obslake.sinks.tables``, with its columns in the declared order."""
    schema = TABLE_SCHEMAS[name]
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}").select(*schema.names)


def read_embeddings(spark: SparkSession, root: str) -> DataFrame:
    """(article_id, embedding): vectors are found by id, never by position."""
    return read_table(spark, root, "embeddings")


def register_views(spark: SparkSession, root: str, names: list[str] | None = None) -> None:
    """Make stored tables available to ``spark.sql`` under their own names."""
    for name in names or ["dim_company", "dim_article", "fact_arr_observation"]:
        read_table(spark, root, name).createOrReplaceTempView(name)
