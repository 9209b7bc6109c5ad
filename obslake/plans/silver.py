"""Silver: one cleaned row per article, and the two audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.category import standardize_category
from obslake.functions.dates import with_parsed_date
from obslake.functions.keys import article_key, company_key
from obslake.functions.money import with_parsed_revenue
from obslake.functions.text import strip
from obslake.operators.resolve import with_company
from obslake.rules import DEFAULT_RULES, Rules
from obslake.schemas import (
    PARSE_ERRORS, RAW_ARTICLES, SILVER_ARTICLES, UNMATCHED_COMPANIES, conform,
)

VALID_REVENUE = ("valid", "valid_range")


def clean_articles(
    articles: DataFrame, companies: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """silver_articles plus ``published_date_raw`` and ``date_parse_status`` for the audit."""
    df = conform(articles, RAW_ARTICLES)
    df = with_company(df, companies, "company_name", rules)
    df = with_parsed_date(df, "published_date", "_date", rules)
    df = with_parsed_revenue(df, "revenue", "_money", rules)
    return df.select(
        article_key(F.col("article_id")).alias("article_id"),
        F.col("article_id").alias("source_article_id"),
        "title",
        F.coalesce(strip(F.col("company_name")), F.lit("")).alias("company_name_raw"),
        "company_name_resolved",
        company_key(F.col("company_name_resolved")).alias("company_id"),
        F.col("_date.date").alias("published_date"),
        F.col("_date.year").alias("published_year"),
        F.col("_date.quarter").alias("published_quarter"),
        F.col("_date.month").alias("published_month"),
        F.col("category").alias("category_raw"),
        standardize_category(F.col("category"), rules).alias("category_standardized"),
        F.col("revenue").alias("revenue_raw"),
        F.col("_money.currency_original").alias("revenue_currency"),
        F.col("_money.is_range").alias("revenue_is_range"),
        F.col("_money.arr_usd").alias("arr_usd"),
        F.col("_money.parse_status").alias("arr_parse_status"),
        "summary", "url", "author", "word_count",
        F.col("published_date").alias("published_date_raw"),
        F.col("_date.parse_status").alias("date_parse_status"),
    )


def silver_articles(cleaned: DataFrame) -> DataFrame:
    return conform(cleaned, SILVER_ARTICLES)


def parse_errors(cleaned: DataFrame) -> DataFrame:
    """One row per article and field that failed to parse, both fields from one scan."""

    def problem(failed, field, raw, issue):
        return F.when(failed, F.struct(
            F.lit(field).alias("field"), raw.alias("raw_value"), issue.alias("issue")))

    revenue_status, date_status = F.col("arr_parse_status"), F.col("date_parse_status")
    problems = F.array_compact(F.array(
        problem(~revenue_status.isin(*VALID_REVENUE), "revenue", F.col("revenue_raw"),
                revenue_status),
        problem(date_status != "valid", "published_date", F.col("published_date_raw"),
                date_status),
    ))
    failed = ~revenue_status.isin(*VALID_REVENUE) | (date_status != "valid")
    return conform(
        cleaned.where(failed).select(
            "article_id", "source_article_id",
            F.coalesce("company_name_resolved", "company_name_raw").alias("company_name"),
            F.inline(problems)),
        PARSE_ERRORS)


def unmatched_companies(cleaned: DataFrame) -> DataFrame:
    """How many articles each unresolved name has, most frequent first."""
    counts = (
        cleaned.where(F.col("company_name_resolved").isNull())
        .groupBy("company_name_raw").agg(F.count(F.lit(1)).alias("article_count"))
    )
    return conform(counts, UNMATCHED_COMPANIES).orderBy(
        F.col("article_count").desc(), "company_name_raw")


def unmatched_names(
    articles: DataFrame, companies: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """The same counts straight from raw articles, of which only the name is read."""
    named = with_company(conform(articles, RAW_ARTICLES).select("company_name"), companies, "company_name", rules)
    return unmatched_companies(named.withColumn(
        "company_name_raw", F.coalesce(strip(F.col("company_name")), F.lit(""))))
