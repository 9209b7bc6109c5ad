"""Category taxonomy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.functions.text import lookup, strip
from obslake.rules import DEFAULT_RULES, UNKNOWN_CATEGORY, Rules


def standardize_category(col: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Taxonomy group of a category, compared after trimming and with its case kept."""
    return F.coalesce(lookup(strip(col), dict(rules.category_groups)), F.lit(UNKNOWN_CATEGORY))


def is_ai_category(group: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return F.coalesce(group.isin(*rules.ai_groups), F.lit(False))
