"""The AI article export and the table writers of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.category import is_ai_category
from obslake.rules import DEFAULT_RULES, Rules
from obslake.schemas import AI_EXPORT_COLUMNS


def ai_article_filter(rules: Rules = DEFAULT_RULES) -> Column:
    """AI by category or by the company's industry, within the years, above the amount."""
    industry_ai = F.coalesce(F.col("industry").isin(*rules.ai_industries), F.lit(False))
    return (
        (is_ai_category(F.col("category_standardized"), rules) | industry_ai)
        & F.col("published_year").between(rules.ai_year_from, rules.ai_year_to)
        & (F.col("arr_usd") > rules.ai_arr_above)
    )


def _required(column: str) -> Column:
    missing = F.concat(F.lit(f"no {column} for article "), F.col("article_id"))
    return F.when(F.col(column).isNull(), F.raise_error(missing)).otherwise(F.col(column))


def attach(articles: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Add a column found by article id; an article without a value fails the job."""
    found = articles.drop(column).join(values.select("article_id", column), "article_id", "left")
    return found.withColumn(column, _required(column))


def ai_articles_enriched(
    articles: DataFrame, embeddings: DataFrame | None = None,
    top_similar: DataFrame | None = None, rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Filtered, projected export; the neighbour column exists only when neighbours are given."""
    # the filter comes first, so vectors are joined to the qualifying articles only
    rows = articles.where(ai_article_filter(rules)).withColumns({
        "company_name": F.coalesce("company_name_resolved", "company_name_raw"),
        "category": F.col("category_raw"),
    })
    columns = list(AI_EXPORT_COLUMNS)
    if embeddings is None:
        rows = rows.withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        rows = attach(rows, embeddings, "embedding")
    if top_similar is not None:
        rows = attach(rows, top_similar, "top_similar_articles")
        columns.append("top_similar_articles")
    return rows.select(*columns)
