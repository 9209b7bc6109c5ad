"""Text -> vectors in Arrow batches, with any encoder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.text import strip
from obslake.functions.vectors import SMALLEST_NORM

DIMENSION = 384
# texts that are decoded and encoded together, however large the batches are that Spark hands over
TEXTS_AT_ONCE = 64
Encoder = Callable[[list[str]], np.ndarray]


def article_text(title: Column, summary: Column) -> Column:
    """Title and summary as one text; a missing part leaves its place empty."""
    blank = F.lit("")
    return strip(F.concat(F.coalesce(title, blank), F.lit(" "), F.coalesce(summary, blank)))


def unit_rows(vectors) -> np.ndarray:
    """Scale every row to length one; a zero row stays zero."""
    matrix = np.asarray(vectors, dtype=np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True).clip(min=SMALLEST_NORM)


class LexicalEncoder:
    """Hashed word counts scaled to length one.

    Deterministic and free of model files, but lexical: texts are close when they share words, not
    meaning. Pass a factory for a sentence model to ``encode_text`` for semantic vectors.
    """

    words = re.compile(r"[^\W_]+")
    remembered_words = 50_000

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension
        self._buckets: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        bucket = self._buckets.get(word)
        if bucket is None:
            if len(self._buckets) >= self.remembered_words:
                self._buckets.clear()
            digest = hashlib.md5(word.encode("utf-8"), usedforsecurity=False).digest()
            bucket = self._buckets[word] = int.from_bytes(digest[:4], "big") % self.dimension
        return bucket

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dimension))
        for i, text in enumerate(texts):
            buckets = [self._bucket(word) for word in self.words.findall(text.lower())]
            counts[i] = np.bincount(buckets, minlength=self.dimension)
        return unit_rows(counts)


def encode_text(
    df: DataFrame, text: Column, encoder_factory: Callable[[], Encoder] = LexicalEncoder,
    id_column: str = "article_id",
) -> DataFrame:
    """(id, embedding) of every row, in vectors of length one.

    The factory runs once per task, on the executor, so a model is loaded there and only there. The
    encoder gets at most ``TEXTS_AT_ONCE`` texts at a time, so memory does not follow Spark's batches.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_factory()
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                vectors = unit_rows(encoder(batch.column(1).to_pylist())).astype(np.float32)
                flat = pa.array(vectors.ravel())
                offsets = np.arange(0, len(flat) + 1, vectors.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                    names=[id_column, "embedding"])

    schema = T.StructType([
        T.StructField(id_column, df.schema[id_column].dataType),
        T.StructField("embedding", T.ArrayType(T.FloatType()))])
    source = df.select(id_column, F.coalesce(text, F.lit("")).alias("text"))
    return source.mapInArrow(encode, schema)
