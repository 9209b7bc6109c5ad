"""String helpers shared by the cleaning functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.rules import NULL_TOKENS

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Trim all Unicode white space, where SQL ``trim`` alone removes spaces only."""
    return F.trim(col, F.lit(WHITESPACE))


def fold_null_tokens(col: Column) -> Column:
    """NULL and the usual "no value" spellings become the empty string."""
    return F.when(col.isNull() | col.isin(*NULL_TOKENS), F.lit("")).otherwise(col)


def lookup(col: Column, table: dict) -> Column:
    """Map a column through a small fixed table; values outside it become NULL."""
    entries = F.create_map(*[F.lit(x) for entry in table.items() for x in entry])
    return F.try_element_at(entries, col)


def compact(col: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]", "")


def evaluate_once(df, **structs):
    """Add struct columns through a one-row ``inline``.

    Catalyst pushes a filter below a projection by repeating the projected expression, so a
    filter on a parsed value would run the whole parse twice. A predicate on the output of a
    generator stays above it, while predicates on other columns still reach the scan.
    """
    row = F.struct(*[value.alias(name) for name, value in structs.items()])
    return df.select("*", F.inline(F.array(row)))
