"""Left joins of a large table to a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_OVERHEAD = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of a table when held in memory, measured by one aggregation over it."""
    width = F.octet_length(F.to_json(F.struct("*"))) + ROW_OVERHEAD
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    left: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left",
) -> DataFrame:
    """Join a large table to a lookup table, whatever the lookup table's size.

    Nothing is run to measure it. Spark broadcasts a lookup table whose files or, at run time, whose
    shuffled bytes are below ``spark.sql.autoBroadcastJoinThreshold``, so the large side is not
    sorted and a hot key does no harm. A larger one is joined by shuffle, where adaptive execution
    splits the partition of a hot key over many tasks.
    """
    return left.join(lookup, on, how)
