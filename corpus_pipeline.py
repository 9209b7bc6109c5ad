"""Cleaning of a corpus, stage by stage; each stage reads what the one before it wrote.

Language ID drops documents without a language (null text, no letters). Line dedup deletes later
copies of repeated runs of lines and drops documents of which no word is left. Near-dedup keeps the
document with the least id of each group, and all documents without text. Decontamination drops documents that
hold a benchmark item, by its template or word for word in any case. The last stage encodes the texts and returns ids in place of the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import cross_parsing, line_runs, nbest_pieces
from obslake.llm.order_minhash import near_duplicates
from obslake.llm.tables import checked_join
from obslake.llm.templates import find_copies, find_leaks
from obslake.session import materialise, work_folder

WORD = r"[^\x20\x09-\x0D]"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    predicted = cross_parsing.identify(docs)
    return predicted.where(F.col("_lang_pred") != cross_parsing.UNKNOWN).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_runs.delete_repeated_runs(docs)
    emptied = (F.col("_n_removed") > 0) & ~F.regexp_like("text", F.lit(WORD))
    return kept.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = near_duplicates(docs)
    later = materialise(
        classes.where(F.col("class_id") < F.col("doc_id")).select(F.col("doc_id").alias("_id")).distinct(),
        "later-copies")
    return checked_join(docs, later, docs["doc_id"] == later["_id"], "left_anti", row_bytes=32)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs, benchmark).select("doc_id").unionByName(find_copies(docs, benchmark).select("doc_id"))
    found = materialise(leaks.select(F.col("doc_id").alias("_id")).distinct(), "leaked-documents")
    return checked_join(docs, found, docs["doc_id"].eqNullSafe(found["_id"]), "left_anti", row_bytes=32)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = nbest_pieces.encode(docs.select("doc_id", "text"))
    return encoded.select(
        "doc_id", F.col("_n_ids").alias("n_ids"), F.col("_ids").alias("ids"),
        F.col("_scores").alias("scores"), F.col("_round_trip").alias("round_trip"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near_copies),
    ("decontamination", decontaminate),
    ("pieces", encode_pieces),
]

#: Language models and piece lattices have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
