"""The k most similar other rows of every row.

The exact search compares everything with everything, which no index avoids for arbitrary
vectors, so the work is laid out as a grid: ids are hashed into blocks of bounded size, each
unordered pair of blocks is one group, a matrix product scores it and only the k best per row leave
the task. Shuffled are one copy of each vector per block and k candidates per row and block, never
the pairs. Copies of one vector are nothing special: they land in different blocks, and each row
still emits k rows.

The approximate search restricts the comparison to rows that share a bucket of a random projection.
Each bucket is laid out as its own grid, so a bucket that holds a large share of all rows is split
like the exact case.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.operators.encode import unit_rows
from obslake.operators.lookup import lookup_join
from obslake.session import materialise

# a cell of the grid holds two blocks; at 384 dimensions a block is 25 MB
BLOCK_ROWS = 16_384
# a tile of scores is 4 MB; only the vectors of a tile are held in doubles
ROWS_AT_ONCE = 256
OTHERS_AT_ONCE = 2_048
# smaller blocks are not worth a task of their own
SMALLEST_BLOCK = 256
# scores closer than this are equal, so copies tie whatever order the sums were taken in
DECIMALS = 12


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _leading(row: np.ndarray, other: np.ndarray, score: np.ndarray, k: int):
    """The k best triples of each row, ties by position."""
    order = np.lexsort((other, -score, row))
    row, other, score = row[order], other[order], score[order]
    top = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[top], other[top], score[top]


def _best(vectors: np.ndarray, mine: np.ndarray, others: np.ndarray, k: int, codes: np.ndarray | None):
    """(row, other, score) triples of the k best others per row, as positions in ``vectors``.

    Rows are scaled and scored a tile at a time, and k triples per row are kept, so the work arrays are
    as large as a tile, whatever the block. ``codes`` tells ids that are their own neighbours.
    """
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for left in range(0, len(others), OTHERS_AT_ONCE):
        theirs = others[left:left + OTHERS_AT_ONCE]
        tile = unit_rows(vectors[theirs]).T
        keep = min(k, len(theirs))
        found = [best]
        for start in range(0, len(mine), ROWS_AT_ONCE):
            rows = mine[start:start + ROWS_AT_ONCE]
            scores = unit_rows(vectors[rows]) @ tile
            np.round(scores, DECIMALS, out=scores)
            if codes is not None:
                scores[codes[rows, None] == codes[None, theirs]] = -np.inf
            limit = np.partition(scores, len(theirs) - keep, axis=1)[:, len(theirs) - keep]
            row, other = np.nonzero((scores >= limit[:, None]) & np.isfinite(scores))
            found.append(_leading(rows[row], theirs[other], scores[row, other], k))
        best = _leading(*(np.concatenate(part) for part in zip(*found)), k)
    return best


def _grid_cell(k: int):
    def best_in_cell(key: tuple, table: pa.Table) -> pa.Table:
        low, high = (scalar.as_py() for scalar in key[-2:])
        table = table.sort_by("id")  # positions then order like ids, which settles ties
        ids, vectors = table["id"].combine_chunks(), _matrix(table["vector"])
        block = table["block"].to_numpy()
        codes = ids.dictionary_encode().indices.to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        directions = [(left, right)] if low == high else [(left, right), (right, left)]
        parts = []
        for mine, others in directions:
            if len(mine) and len(others):
                row, other, score = _best(vectors, mine, others, k, codes if low == high else None)
                parts.append(pa.table({
                    "id": ids.take(pa.array(row)),
                    "neighbour": ids.take(pa.array(other)),
                    "score": score,
                }))
        if not parts:
            return pa.table({
                "id": ids.slice(0, 0), "neighbour": ids.slice(0, 0),
                "score": pa.array([], pa.float64())})
        return pa.concat_tables(parts)

    return best_in_cell


def _cells(rows: DataFrame, blocks: Column) -> DataFrame:
    """One copy of each row for every cell of its bucket's grid that it belongs to."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks.cast("long")).withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select("bucket", "id", "vector", "block",
                F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy(F.col("score").desc(), "neighbour")
    return (
        candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("id", "rank", "neighbour", F.round("score", 6).alias("similarity"))
    )


def _candidates(cells: DataFrame, k: int) -> DataFrame:
    id_type = cells.schema["id"].dataType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("neighbour", id_type),
        T.StructField("score", T.DoubleType())])
    return cells.groupBy("bucket", "low", "high").applyInArrow(_grid_cell(k), schema)


def grid_size(rows: int, block_rows: int, cores: int) -> int:
    """Blocks of a grid: as many as memory asks for, or enough that each core has a cell of it."""
    by_memory = ceil(rows / block_rows)
    by_cores = ceil((sqrt(8 * cores + 1) - 1) / 2)  # b blocks make b * (b + 1) / 2 cells
    return max(1, by_memory, min(by_cores, ceil(rows / SMALLEST_BLOCK)))


def top_neighbours(
    vectors: DataFrame, k: int = 3, id_column: str = "article_id",
    vector_column: str = "embedding", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact search: (id, rank, neighbour, similarity), best first, equal scores by lowest id.

    A row is never its own neighbour; with k rows or fewer there are fewer than k neighbours.
    """
    rows = vectors.where(F.col(vector_column).isNotNull()).select(
        F.lit(0).alias("bucket"), F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    blocks = grid_size(rows.count(), block_rows, vectors.sparkSession.sparkContext.defaultParallelism)
    return _ranked(_candidates(_cells(rows, F.lit(blocks)), k), k)


def projection_buckets(
    vectors: DataFrame, tables: int, bucket_length: float, seed: int = 42
) -> DataFrame:
    """(bucket, id, vector) once per hash table, from unit vectors in columns id and vector."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    featured = vectors.withColumn("features", array_to_vector(F.col("vector").cast("array<double>")))
    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", numHashTables=tables, bucketLength=bucket_length,
        seed=seed).fit(featured)
    return (
        model.transform(featured).select("id", "vector", F.posexplode("hashes").alias("table", "hash"))
        .select(F.xxhash64("table", vector_to_array("hash")).alias("bucket"), "id", "vector")
    )


def approximate_neighbours(
    vectors: DataFrame, k: int = 3, id_column: str = "article_id",
    vector_column: str = "embedding", block_rows: int = BLOCK_ROWS, tables: int = 4,
    bucket_length: float = 0.5,
) -> DataFrame:
    """Opt-in search that may miss neighbours which share no bucket; scores are exact."""
    rows = vectors.where(F.col(vector_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    hashed = projection_buckets(rows, tables, bucket_length)
    sizes = materialise(hashed.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("bucket_blocks")), "bucket-sizes")
    cells = _cells(lookup_join(hashed, sizes, "bucket"), F.col("bucket_blocks"))
    pairs = _candidates(cells, k).groupBy("id", "neighbour").agg(F.max("score").alias("score"))
    return _ranked(pairs, k)


def as_lists(neighbours: DataFrame, ids: DataFrame, id_column: str = "article_id") -> DataFrame:
    """(id, top_similar_articles): the neighbour ids of every row, best first, perhaps none."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "neighbour")))
    lists = neighbours.groupBy(F.col("id").alias(id_column)).agg(
        F.transform(ranked, lambda r: r["neighbour"]).alias("top_similar_articles"))
    nothing = F.array().cast(lists.schema["top_similar_articles"].dataType)
    return ids.select(id_column).join(lists, id_column, "left").withColumn(
        "top_similar_articles", F.coalesce("top_similar_articles", nothing))
