"""Revenue text -> whole US dollars, as native expressions over a whole table.

The work is laid out as a chain of projections, each step a column that the next step reads, so
each regular expression runs once per row, and only on rows that a plain substring test has let
through. A step whose input is NULL costs nothing, as for the second side of what is no range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import evaluate_once, lookup, strip
from obslake.rules import CURRENCY_SYMBOLS, DEFAULT_RULES, SCALE_LETTERS, SCALE_WORDS, Rules

# Fixed patterns of the accepted notation. A code and a suffix letter must not run into a word,
# where any letter, digit or underscore continues one.
CODES = ("usd", "eur", "gbp", "jpy")
CODE = r"(?i)(?<![\p{L}\p{N}_])(USD|EUR|GBP|JPY)(?![\p{L}\p{N}_])"
WORD = r"(?i)(thousand|million|billion|trillion)"
SUFFIX = r"[0-9][.,]*+(?U:\s*+)([KMBTkmbt])(?![\p{L}\p{N}_])"
NUMBER = r"[0-9][0-9.,]*"
RANGE_MARKS = ("-", "to", "–", "—")
RANGE = "-|to|–|—"


def _contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def currency_of(text: Column, may_hold_code: Column) -> Column:
    """First currency symbol found, else an ISO code, else USD."""
    result = F.when(text.isNull(), None)
    for symbol, currency in CURRENCY_SYMBOLS.items():
        result = result.when(text.contains(symbol), currency)
    code = F.when(may_hold_code, F.nullif(F.upper(F.regexp_extract(text, CODE, 1)), F.lit("")))
    return result.otherwise(F.coalesce(code, F.lit("USD")))


def _with_amounts(df: DataFrame, names: list[str], rules: Rules) -> DataFrame:
    """Read one amount, in US dollars, from each text column; the results get the suffix _usd.

    The table-wide columns _m_code and _m_word say whether a row can hold a code or a scale word.
    """
    may_hold_code, may_hold_word = F.col("_m_code"), F.col("_m_word")

    def step(frame: DataFrame, name: str, build) -> DataFrame:
        return frame.withColumns({f"{n}_{name}": build(lambda c, n=n: F.col(f"{n}{c}")) for n in names})

    def without_codes(at) -> Column:
        text = F.when(may_hold_code, F.regexp_replace(at(""), CODE, "")).otherwise(at(""))
        return F.translate(text, "".join(CURRENCY_SYMBOLS), "")

    def digits(at) -> Column:
        # the suffix letter goes once, wherever it first occurs
        cut = F.overlay(at("_rest"), F.lit(""), F.instr(at("_rest"), at("_letter")), F.lit(1))
        text = F.when(at("_letter") == "", at("_rest")).otherwise(cut)
        return F.replace(F.regexp_extract(text, NUMBER, 0), F.lit(","), F.lit(""))

    def amount(at) -> Column:
        # several dots separate thousands
        undotted = F.replace(at("_digits"), F.lit("."), F.lit(""))
        many_dots = F.length(at("_digits")) - F.length(undotted) > 1
        value = F.when(many_dots, undotted).otherwise(at("_digits")).try_cast("double")
        letter = lookup(F.upper(at("_letter")), SCALE_LETTERS)
        scale = F.coalesce(letter, lookup(at("_scale_word"), SCALE_WORDS), F.lit(1.0))
        return value * scale * lookup(at("_currency"), dict(rules.fx_to_usd))

    df = step(df, "bare", without_codes)
    df = step(df, "scale_word", lambda at: F.when(
        may_hold_word, F.lower(F.regexp_extract(at("_bare"), WORD, 1))))
    df = step(df, "rest", lambda at: F.when(
        may_hold_word, F.regexp_replace(at("_bare"), WORD, "")).otherwise(at("_bare")))
    df = step(df, "letter", lambda at: F.regexp_extract(at("_rest"), SUFFIX, 1))
    df = step(df, "digits", digits)
    df = step(df, "currency", lambda at: currency_of(at(""), may_hold_code))
    df = step(df, "usd", amount)
    done = ("bare", "scale_word", "rest", "letter", "digits")
    return df.drop(*[f"{n}_{name}" for n in names for name in done])


def with_parsed_revenue(
    df: DataFrame, column: str, out: str = "revenue_parsed", rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Add ``out``: struct(arr_usd, currency_original, is_range, parse_status, raw_value, note).

    A range counts as one when splitting gives exactly two sides that both hold a number; each
    side is scaled and converted on its own and the midpoint is taken. Rounding is half to even.
    """
    text, folded, parts, ranged = (F.col(f"_m_{c}") for c in ("text", "folded", "parts", "range"))
    missing = F.col("_m_missing")
    digit = "[0-9]"

    df = df.withColumn("_m_text", strip(F.col(column)))
    df = df.withColumn("_m_folded", F.lower(text))
    df = df.withColumns({
        "_m_missing": text.isNull() | (text == "") | folded.isin(*rules.missing_revenue),
        "_m_code": _contains_any(folded, CODES),
        "_m_word": _contains_any(folded, ("illion", "thousand")),
    })
    df = df.withColumn("_m_parts", F.when(
        ~missing & _contains_any(text, RANGE_MARKS), F.split(text, RANGE)))
    df = df.withColumn("_m_range", F.coalesce(
        (F.size(parts) == 2) & F.get(parts, F.lit(0)).rlike(digit)
        & F.get(parts, F.lit(1)).rlike(digit), F.lit(False)))
    df = df.withColumns({
        "_m_first": F.when(ranged, F.get(parts, F.lit(0))).when(~missing, text),
        "_m_second": F.when(ranged, F.get(parts, F.lit(1))),
    })
    df = _with_amounts(df, ["_m_first", "_m_second"], rules)
    first, second = F.col("_m_first_usd"), F.col("_m_second_usd")
    amount = F.when(ranged, (first + second) / 2.0).otherwise(first)
    df = df.withColumn("_m_usd", F.rint(amount).try_cast("bigint"))

    usd = F.col("_m_usd")
    # the currency of a range is read from its whole text
    currency = F.when(ranged, currency_of(text, F.col("_m_code"))).otherwise(
        F.col("_m_first_currency"))
    status = (
        F.when(missing, "invalid_missing").when(usd.isNull(), "unparseable")
        .when(ranged, "valid_range").otherwise("valid"))
    parsed = F.struct(
        usd.alias("arr_usd"),
        F.when(usd.isNotNull(), currency).alias("currency_original"),
        (ranged & usd.isNotNull()).alias("is_range"),
        status.alias("parse_status"),
        text.alias("raw_value"),
        F.lit(None).cast("string").alias("note"),
    )
    steps = [c for c in df.columns if c.startswith("_m_")]
    return evaluate_once(df, **{out: parsed}).drop(*steps)
