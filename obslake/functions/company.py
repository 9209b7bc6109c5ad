"""Derived company attributes and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.rules import DEFAULT_RULES, Rules


def size_category(employees: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Small / Medium / Large; an unknown head count has no band."""
    return (
        F.when(employees < rules.small_below, "Small")
        .when(employees <= rules.medium_up_to, "Medium")
        .when(employees.isNotNull(), "Large")
    )


def company_age(founded_year: Column, article_year: Column) -> Column:
    """Years between founding and article; negative values are kept for audit."""
    return article_year.cast("bigint") - founded_year.cast("bigint")


def lenient_long(col: Column) -> Column:
    """Whole numbers in any spelling ("2006", "2006.0"); anything else becomes NULL."""
    number = col.try_cast("double")
    return F.coalesce(
        col.try_cast("bigint"), F.when(number == F.rint(number), number.try_cast("bigint")))


def lenient_boolean(col: Column) -> Column:
    return col.try_cast("boolean")
