"""One StructType per table. Nothing in the package infers types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _struct(spec: str) -> T.StructType:
    # StructType.fromDDL would need a running session when the module is imported
    columns = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


RAW_ARTICLE_COLUMNS = (
    "article_id", "title", "company_name", "published_date", "category", "revenue",
    "summary", "url", "author", "word_count",
)
RAW_ARTICLES = T.StructType([T.StructField(c, T.StringType()) for c in RAW_ARTICLE_COLUMNS])

PROVENANCE = "source_file string, source_hash string, ingested_at timestamp"

BRONZE_COMPANIES = _struct(
    "company_name string, founded_year bigint, headquarters string, employee_count bigint, "
    "industry string, is_public boolean, stock_ticker string, " + PROVENANCE
)

SILVER_ARTICLES = _struct(
    "article_id string, source_article_id string, title string, company_name_raw string, "
    "company_name_resolved string, company_id string, published_date date, published_year int, "
    "published_quarter int, published_month int, category_raw string, "
    "category_standardized string, revenue_raw string, revenue_currency string, "
    "revenue_is_range boolean, arr_usd bigint, arr_parse_status string, summary string, "
    "url string, author string, word_count string"
)

DIM_COMPANY = _struct(
    "company_id string, company_name string, industry string, founded_year int, "
    "headquarters string, employee_count bigint, is_public boolean, stock_ticker string"
)

COMPANY_ATTRIBUTES = (
    "industry", "founded_year", "headquarters", "employee_count", "is_public", "stock_ticker",
)

DIM_ARTICLE = T.StructType(
    SILVER_ARTICLES.fields
    + [DIM_COMPANY[c] for c in COMPANY_ATTRIBUTES]
    + _struct("company_age bigint, company_size_category string").fields
)

DIM_ARTICLE_EMBEDDED = T.StructType(DIM_ARTICLE.fields + _struct("embedding array<float>").fields)

EMBEDDINGS = _struct("article_id string, embedding array<float>")

FACT_ARR_OBSERVATION = _struct(
    "arr_observation_id string, company_id string, article_id string, observation_date date, "
    "arr_usd bigint, arr_raw_value string, arr_currency string, arr_is_range boolean"
)

PARSE_ERRORS = _struct(
    "article_id string, source_article_id string, company_name string, field string, "
    "raw_value string, issue string"
)

UNMATCHED_COMPANIES = _struct("company_name_raw string, article_count bigint")

AI_EXPORT_COLUMNS = (
    "article_id", "title", "company_name", "published_date", "category", "arr_usd", "summary",
    "url", "industry", "founded_year", "headquarters", "employee_count", "is_public",
    "stock_ticker", "company_age", "company_size_category", "embedding",
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name and cast them; columns that are absent become NULL."""
    present = set(df.columns)

    def pick(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in present else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select(*[pick(f) for f in schema.fields])
