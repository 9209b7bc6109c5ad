"""Revenue observations over time: snapshots, period ends, growth, series and lineage.

Observations are discrete reports; they are never summed or carried forward. ``row_number`` is
always filtered, so Spark keeps only the leading rows of each group before the shuffle and a
company that holds a large share of all rows adds a few rows per task, not all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.operators.lookup import lookup_join


def latest_observation(
    facts: DataFrame, keys: list[str | Column] | None = None, day: str = "observation_date",
    tie_break: str = "arr_observation_id",
) -> DataFrame:
    """The last row of each group by date; equal dates are settled by the lowest id."""
    order = Window.partitionBy(*(keys or ["company_id"])).orderBy(F.col(day).desc(), tie_break)
    return facts.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def latest_top(facts: DataFrame, n: int = 5) -> DataFrame:
    """The n companies with the highest latest figure."""
    latest = latest_observation(facts).select("company_id", "observation_date", "arr_usd")
    return latest.orderBy(F.col("arr_usd").desc(), "company_id").limit(n)


def with_dimensions(facts: DataFrame, companies: DataFrame, articles: DataFrame) -> DataFrame:
    """Facts with their company name and the article's period labels."""
    labels = articles.select("article_id", "published_year", "published_quarter")
    names = companies.select("company_id", "company_name")
    return lookup_join(facts, names, "company_id", "inner").join(labels, "article_id")


def with_periods(facts: DataFrame) -> DataFrame:
    """Period labels from the observation date, which is the article's date: no join needed."""
    return facts.withColumns({
        "published_year": F.year("observation_date"),
        "published_quarter": F.quarter("observation_date"),
    })


PERIOD = ["company_id", "published_year", "published_quarter"]


def quarterly_last(labelled: DataFrame) -> DataFrame:
    """The last figure of each company within each quarter."""
    return latest_observation(labelled, PERIOD).select(*PERIOD, "observation_date", "arr_usd")


def quarterly_growth(quarterly: DataFrame) -> DataFrame:
    """Change against the company's preceding quarter that has a figure."""
    order = Window.partitionBy("company_id").orderBy("published_year", "published_quarter")
    previous = F.col("previous_arr_usd")
    return quarterly.withColumns({
        "previous_date": F.lag("observation_date").over(order),
        "previous_arr_usd": F.lag("arr_usd").over(order),
    }).withColumns({
        "change_usd": F.col("arr_usd") - previous,
        "change_ratio": F.try_divide((F.col("arr_usd") - previous).cast("double"),
                                     previous.cast("double")),
    })


def company_series(facts: DataFrame, companies: DataFrame, company_name: str) -> DataFrame:
    """Every observation of one company in date order.

    The company's id is a scalar subquery, which runs first, so the facts are filtered while they
    are read instead of being joined.
    """
    chosen = companies.where(F.col("company_name") == company_name).select("company_id")
    return (
        facts.where(F.col("company_id") == chosen.scalar())
        .select("observation_date", "arr_usd", "arr_observation_id")
        .orderBy("observation_date", "arr_observation_id")
    )


def lineage(facts: DataFrame, articles: DataFrame, bronze: DataFrame) -> DataFrame:
    """Each observation with its article's raw value and the source row and file it came from."""
    sources = bronze.select(
        F.col("article_id").alias("source_article_id"), F.col("revenue").alias("source_revenue"),
        "source_file", "source_hash", "ingested_at")
    raw = articles.select("article_id", "source_article_id", "revenue_raw")
    return (
        facts.select("arr_observation_id", "article_id", "observation_date", "arr_usd")
        .join(raw, "article_id").join(sources, "source_article_id")
    )
