"""Top-k vector search, alone and behind relational filters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.vectors import dot, literal, norm
from obslake.operators.encode import Encoder, LexicalEncoder, unit_rows


def find_similar(
    vectors: DataFrame, query: Sequence[float], top_k: int = 5, id_column: str = "article_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k vectors with the largest dot product, ranked before the score is rounded."""
    scored = vectors.select(id_column, dot(F.col(vector_column), literal(query)).alias("score"))
    best = scored.orderBy(F.col("score").desc(), id_column).limit(top_k)
    return best.select(id_column, F.round("score", 6).alias("similarity"))


def article_filter(
    published_year_from: int | None = None, published_year_to: int | None = None,
    arr_min_usd: float | None = None, categories: Sequence[str] | None = None,
    industries: Sequence[str] | None = None,
) -> Column:
    """Conjunction of the given conditions; None and empty lists leave a condition out."""
    conditions = [F.lit(True)]
    if published_year_from is not None:
        conditions.append(F.col("published_year") >= int(published_year_from))
    if published_year_to is not None:
        conditions.append(F.col("published_year") <= int(published_year_to))
    if arr_min_usd is not None:
        conditions.append(F.col("arr_usd") > float(arr_min_usd))
    if categories:
        conditions.append(F.col("category_standardized").isin(*categories))
    if industries:
        conditions.append(F.col("industry").isin(*industries))
    return reduce(lambda a, b: a & b, conditions)


def ranked_by_cosine(
    rows: DataFrame, query: Sequence[float], top_k: int, id_column: str, vector_column: str
) -> DataFrame:
    """The k rows closest to a query of length one, ranked on the rounded score.

    A missing or zero vector scores 0 and stays in the ranking.
    """
    vector = F.col(vector_column)
    length = norm(vector)
    score = F.when(length > 0, dot(vector, literal(query)) / length).otherwise(F.lit(0.0))
    scored = rows.withColumn("similarity", F.round(score, 6)).drop(vector_column)
    return scored.orderBy(F.col("similarity").desc(), id_column).limit(top_k)


def hybrid_search(
    articles: DataFrame, query: Sequence[float], top_k: int = 5, **conditions
) -> DataFrame:
    """Filter articles, then rank what is left by cosine similarity, in one plan."""
    rows = articles.where(article_filter(**conditions)).select(
        "article_id", "title", F.col("company_name_resolved").alias("company_name"),
        "published_year", F.col("category_standardized").alias("category"), "industry", "arr_usd",
        "embedding")
    return ranked_by_cosine(rows, query, top_k, "article_id", "embedding")


def encode_query(text: str, encoder_factory: Callable[[], Encoder] = LexicalEncoder) -> list[float]:
    """Vector of one query text, of length one like the stored vectors."""
    return [float(x) for x in unit_rows(encoder_factory()([text]))[0]]


def find_similar_articles(
    vectors: DataFrame, query_text: str, top_k: int = 5,
    encoder_factory: Callable[[], Encoder] = LexicalEncoder,
) -> DataFrame:
    """Semantic search by free text; the encoder must be the one that made the vectors."""
    return find_similar(vectors, encode_query(query_text, encoder_factory), top_k)


def hybrid_search_articles(
    articles: DataFrame, query_text: str, top_k: int = 5,
    encoder_factory: Callable[[], Encoder] = LexicalEncoder, **conditions,
) -> DataFrame:
    """Hybrid search by free text over articles with embeddings."""
    return hybrid_search(articles, encode_query(query_text, encoder_factory), top_k, **conditions)
