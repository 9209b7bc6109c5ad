"""Mixed-format date text -> date, as native expressions over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import evaluate_once, strip
from obslake.rules import DEFAULT_RULES, Rules

# Fixed patterns of the accepted notation.
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
NUMERIC = r"^[0-9]{1,2}([/-])[0-9]{1,2}\1[0-9]{4}$"
MONTH_DAY_YEAR = r"(?U)^([A-Za-z]{3,})\s+([0-9]{1,2}),?\s*([0-9]{4})$"
DAY_MONTH_YEAR = r"(?U)^([0-9]{1,2})\s+([A-Za-z]{3,})\s+([0-9]{4})$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _month_number(name: Column) -> Column:
    """1..12 from the first three letters of a month name, 0 for anything else."""
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(name, 1, 3)))


def _numeric_month(first: Column, second: Column, rules: Rules) -> Column:
    """Which of the two leading tokens is the month; NULL when neither can be."""
    both = F.least(first, second) if rules.ambiguous_dates == "min_is_month" else first
    return (
        F.when(first.between(1, 12) & second.between(1, 12), both)
        .when(first.between(1, 12), first)
        .when(second.between(1, 12), second)
    )


def with_parsed_date(
    df: DataFrame, column: str, out: str = "date_parsed", rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Add ``out``: struct(date, year, quarter, month, parse_status, raw_value, note)."""
    if rules.ambiguous_dates not in ("min_is_month", "month_first"):
        raise ValueError(f"unknown rule for ambiguous dates: {rules.ambiguous_dates}")
    text, kind, tokens = F.col("_d_text"), F.col("_d_kind"), F.col("_d_tokens")
    df = df.withColumn("_d_text", strip(F.col(column)))
    df = df.withColumn(
        "_d_kind",
        F.when(text.rlike(ISO), "iso")
        .when(text.rlike(NUMERIC), "numeric")
        .when(text.rlike(MONTH_DAY_YEAR), "month_day")
        .when(text.rlike(DAY_MONTH_YEAR), "day_month"),
    )
    # every non-ISO notation is cut into three tokens; "19 2022" and "192022" both need the groups
    groups = {
        "month_day": F.array(*[F.regexp_extract(text, MONTH_DAY_YEAR, i) for i in (1, 2, 3)]),
        "day_month": F.array(*[F.regexp_extract(text, DAY_MONTH_YEAR, i) for i in (2, 1, 3)]),
    }
    df = df.withColumn(
        "_d_tokens",
        F.when(kind == "numeric", F.split(text, "[/-]"))
        .when(kind == "month_day", groups["month_day"])
        .when(kind == "day_month", groups["day_month"]),
    )
    first, second = (F.get(tokens, F.lit(i)).try_cast("int") for i in (0, 1))
    df = df.withColumn(
        "_d_month",
        F.when(kind == "numeric", _numeric_month(first, second, rules))
        .when(kind.isNotNull(), _month_number(F.get(tokens, F.lit(0))).cast("int")),
    )
    day = F.when(kind == "numeric", first + second - F.col("_d_month")).otherwise(second)
    written = F.when(kind == "iso", F.substring(text, 1, 10)).otherwise(
        F.concat(F.get(tokens, F.lit(2)), F.lit("-"), F.col("_d_month").cast("string"), F.lit("-"),
                 day.cast("string")))
    df = df.withColumn("_d_date", written.try_cast("date"))
    # the calendar starts in year 1
    df = df.withColumn("_d_date", F.when(F.year("_d_date") >= 1, F.col("_d_date")))

    date = F.col("_d_date")
    blank = text.isNull() | (text == "")
    parsed = F.struct(
        date.alias("date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.when(blank, "invalid_missing").when(date.isNull(), "invalid").otherwise("valid")
        .alias("parse_status"),
        text.alias("raw_value"),
        F.when(text.isNull(), "missing value").when(text == "", "empty value")
        .when(kind.isNull(), "unrecognised format").when(date.isNull(), "not a calendar date")
        .alias("note"),
    )
    return evaluate_once(df, **{out: parsed}).drop(
        "_d_text", "_d_kind", "_d_tokens", "_d_month", "_d_date")
