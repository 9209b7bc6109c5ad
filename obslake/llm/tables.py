"""Joins to tables of checked size, and connected components of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from obslake.session import materialise

#: A table is broadcast up to this size in memory, by its counted rows.
BROADCAST_LIMIT = 32 << 20


def checked_join(
    left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "left",
    row_bytes: int = 64, limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join to a written table of rows of bounded width, broadcast only if its rows are counted to fit.

    Beyond the limit it is a shuffled join, where adaptive execution splits the partition of a hot
    key. The count is read from the footers of the files.
    """
    return left.join(F.broadcast(right) if right.count() * row_bytes <= limit else right, on, how)


class Carried:
    """The columns of a table beside its text, packed into one so that no name clashes with a step's.

    Columns named like a result are replaced by it.
    """

    def __init__(self, table: DataFrame, made: StructType):
        self.names = [c for c in table.columns if c not in made.fieldNames()]
        others = [c for c in self.names if c != "text"]
        # a struct has a field at least
        self.row = F.struct(F.lit(0).alias(""), *[table[f"`{c}`"] for c in others]).alias("row")
        kind = table.select(self.row).schema["row"]
        self.made = made
        self.packed = StructType([kind, StructField("text", table.schema["text"].dataType)])
        self.schema = StructType([*self.packed.fields, *made.fields])

    def unpack(self, table: DataFrame) -> DataFrame:
        columns = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in self.names]
        return table.select(*columns, *self.made.fieldNames())


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), for every node but the roots.

    The root is the least node of its component. Each round hooks every node to its least
    neighbour, shortens the paths to their ends, and maps the links to those ends; a star of any
    size takes one round. Every round is a written table, so nothing is recomputed.
    """
    edges = materialise(
        links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .where(F.col("low") < F.col("high")).distinct(), "links")
    found = None
    while not edges.isEmpty():
        parent = materialise(edges.groupBy("high").agg(F.min("low").alias("low")), "parents")
        while True:
            above = parent.select(F.col("high").alias("low"), F.col("low").alias("above"))
            further = parent.join(above, "low", "left").select(
                "high", F.coalesce("above", "low").alias("low"),
                F.col("above").isNotNull().alias("moved"))
            further = materialise(further, "parents")
            parent = further.select("high", "low")
            if further.where("moved").isEmpty():
                break
        moved = parent.select(F.col("high").alias("node"), F.col("low").alias("root"))
        if found is None:
            found = moved
        else:
            again = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = found.join(again, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")).unionByName(moved)
        found = materialise(found, "components")
        low = parent.select(F.col("high").alias("low"), F.col("low").alias("_l"))
        high = parent.select("high", F.col("low").alias("_h"))
        ends = edges.join(low, "low", "left").join(high, "high", "left").select(
            F.coalesce("_l", "low").alias("x"), F.coalesce("_h", "high").alias("y"))
        edges = materialise(
            ends.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"))
            .where(F.col("low") < F.col("high")).distinct(), "links")
    if found is None:
        return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return found
