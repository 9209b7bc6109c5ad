"""Deterministic surrogate keys, so that a rebuild gives the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(prefix: str, natural_key: Column, digits: int) -> Column:
    # concat, not concat_ws: a NULL natural key must give a NULL surrogate key
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha1(natural_key), 1, digits)))


def company_key(canonical_name: Column) -> Column:
    return _digest("COMP-", canonical_name, 16)


def article_key(source_article_id: Column) -> Column:
    return _digest("ART-", source_article_id, 16)


def observation_key(company_id: Column, article_id: Column, day: Column) -> Column:
    bar = F.lit("|")
    day_text = F.date_format(day, "yyyy-MM-dd")
    return _digest("ARR-", F.concat(company_id, bar, article_id, bar, day_text), 24)
