"""The whole run: bronze -> silver -> gold, vectors, export and tables.

    spark-submit --py-files obslake.zip job.py --articles DIR --companies FILE --out DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators.encode import LexicalEncoder, article_text, encode_text
from obslake.operators.neighbours import approximate_neighbours, as_lists, top_neighbours
from obslake.operators.quality import table_counts
from obslake.plans.export import ai_articles_enriched, attach
from obslake.plans.gold import dim_article, dim_company, fact_arr_observation
from obslake.plans.silver import (
    clean_articles, parse_errors, silver_articles, unmatched_companies,
)
from obslake.rules import DEFAULT_RULES, Rules
from obslake.session import build_session, materialise
from obslake.sinks.tables import write_csv, write_embeddings, write_table
from obslake.sources.files import read_articles, read_companies
from obslake.sources.tables import read_embeddings


@dataclass(frozen=True)
class Tables:
    bronze_articles: DataFrame
    bronze_companies: DataFrame
    silver_articles: DataFrame
    dim_company: DataFrame
    dim_article: DataFrame
    fact_arr_observation: DataFrame
    unmatched_companies: DataFrame
    parse_errors: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build_tables(
    articles: DataFrame, companies: DataFrame, rules: Rules = DEFAULT_RULES,
    root: str | None = None,
) -> Tables:
    """All tables from the two bronze frames.

    Cleaned articles feed five tables, so they are written once and read back.
    """
    cleaned = materialise(clean_articles(articles, companies, rules), "cleaned_articles", root)
    silver, dimension = silver_articles(cleaned), dim_company(companies)
    return Tables(
        bronze_articles=articles,
        bronze_companies=companies,
        silver_articles=silver,
        dim_company=dimension,
        dim_article=dim_article(silver, dimension, rules),
        fact_arr_observation=fact_arr_observation(silver),
        unmatched_companies=unmatched_companies(cleaned),
        parse_errors=parse_errors(cleaned),
    )


def run_pipeline(
    spark: SparkSession, articles_path: str, companies_path: str, rules: Rules = DEFAULT_RULES,
    multi_line: bool = True, root: str | None = None,
) -> Tables:
    """Bronze is kept as a columnar copy, since later steps read single columns of it.

    With ``root`` the bronze and cleaned layers are tables there, otherwise intermediate copies.
    """
    articles = read_articles(spark, articles_path, multi_line)
    companies = read_companies(spark, companies_path)
    return build_tables(
        materialise(articles, "bronze_articles", root),
        materialise(companies, "bronze_companies", root), rules, root)


def run_job(
    spark: SparkSession, articles_path: str, companies_path: str, out: str,
    with_embeddings: bool = True, with_tables: bool = True,
    encoder_factory: Callable = LexicalEncoder, rules: Rules = DEFAULT_RULES,
    multi_line: bool = True, exact_neighbours: bool = True,
) -> DataFrame:
    """Write every table under ``out``; returns (table_name, row_count)."""
    layers = f"{out}/layers"
    tables = run_pipeline(spark, articles_path, companies_path, rules, multi_line, layers)
    embeddings = neighbours = None
    if with_embeddings:
        text = article_text(F.col("title"), F.col("summary"))
        write_embeddings(encode_text(tables.silver_articles, text, encoder_factory), out)
        embeddings = read_embeddings(spark, out)
        search = top_neighbours if exact_neighbours else approximate_neighbours
        neighbours = materialise(as_lists(search(embeddings), embeddings), "top_similar_articles", layers)
    export = ai_articles_enriched(tables.dim_article, embeddings, neighbours, rules)
    for name, table in {**tables.by_name(), "ai_articles_enriched": export}.items():
        write_csv(table, f"{out}/csv", name)
    if with_tables:
        articles = tables.dim_article
        if embeddings is not None:
            articles = attach(articles, embeddings, "embedding")
        write_table(tables.dim_company, out, "dim_company")
        write_table(articles, out, "dim_article")
        write_table(tables.fact_arr_observation, out, "fact_arr_observation")
    return table_counts({**tables.by_name(), "ai_articles_enriched": export})


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the company revenue tables.")
    parser.add_argument("--articles", required=True, help="CSV file or folder")
    parser.add_argument("--companies", required=True, help="JSON file or folder")
    parser.add_argument("--out", required=True, help="folder for all tables")
    parser.add_argument("--no-embeddings", action="store_true")
    parser.add_argument("--no-tables", action="store_true")
    parser.add_argument("--single-line", action="store_true",
                        help="no cell holds a line break, so large files can be split")
    parser.add_argument("--approximate-neighbours", action="store_true",
                        help="search within random-projection buckets, not among all articles")
    options = parser.parse_args(arguments)
    spark = build_session()
    counts = run_job(
        spark, options.articles, options.companies, options.out,
        with_embeddings=not options.no_embeddings, with_tables=not options.no_tables,
        multi_line=not options.single_line, exact_neighbours=not options.approximate_neighbours)
    counts.orderBy("table_name").show(truncate=False)


if __name__ == "__main__":
    main()
