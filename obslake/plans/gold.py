"""Gold: company and article dimensions and the fact table of valid observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.company import company_age, size_category
from obslake.functions.keys import company_key, observation_key
from obslake.operators.lookup import lookup_join
from obslake.rules import DEFAULT_RULES, Rules
from obslake.schemas import (
    COMPANY_ATTRIBUTES, DIM_ARTICLE, DIM_COMPANY, FACT_ARR_OBSERVATION, conform,
)


def dim_company(companies: DataFrame) -> DataFrame:
    """One row per company; of several the last by file, then by content."""
    file = F.col("source_file") if "source_file" in companies.columns else F.lit(None).cast("string")
    row = F.struct(*companies.columns)
    single = companies.groupBy("company_name").agg(
        F.max_by(row, F.struct(file.alias("file"), F.to_json(row).alias("row"))).alias("c")).select("c.*")
    keyed = single.withColumn("company_id", company_key(F.col("company_name")))
    # a founding year beyond the integer range is no year
    year = F.col("founded_year").try_cast("int")
    return conform(keyed.withColumn("founded_year", year), DIM_COMPANY)


def enrich_articles(
    articles: DataFrame, companies: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Left join to the company attributes; derives age and size at article grain."""
    attributes = companies.select("company_id", *COMPANY_ATTRIBUTES)
    return lookup_join(articles, attributes, "company_id").withColumns({
        "company_age": company_age(F.col("founded_year"), F.col("published_year")),
        "company_size_category": size_category(F.col("employee_count"), rules),
    })


def dim_article(
    silver: DataFrame, companies: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    return conform(enrich_articles(silver, companies, rules), DIM_ARTICLE)


def fact_arr_observation(silver: DataFrame) -> DataFrame:
    """One row per article with an amount, a company and a date."""
    valid = silver.where(
        F.col("arr_usd").isNotNull() & F.col("company_id").isNotNull()
        & F.col("published_date").isNotNull())
    key = observation_key(F.col("company_id"), F.col("article_id"), F.col("published_date"))
    return conform(
        valid.select(
            key.alias("arr_observation_id"), "company_id", "article_id",
            F.col("published_date").alias("observation_date"), "arr_usd",
            F.col("revenue_raw").alias("arr_raw_value"),
            F.col("revenue_currency").alias("arr_currency"),
            F.col("revenue_is_range").alias("arr_is_range")),
        FACT_ARR_OBSERVATION)
