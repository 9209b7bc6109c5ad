"""The operators of this folder as queries over the given tables, with the same result in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import cross_parsing, legacy_archive, line_runs, nbest_pieces, slot_map
from obslake.llm.conversation_repair import repair_conversations
from obslake.llm.credential_grammar import find_secrets
from obslake.llm.order_minhash import near_duplicates
from obslake.llm.periodic_runs import find_runs
from obslake.llm.robust_outliers import judge
from obslake.llm.substrings import remove_repeated_windows
from obslake.llm.templates import find_copies, find_leaks
from obslake.llm.url_rules import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op1_verbatim_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op3_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = nbest_pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return encoded.select(
        "doc_id", F.col("_n_ids").alias("n_ids"), F.col("_ids_sha256").alias("ids_sha256"),
        F.col("_scores").alias("scores"), F.col("_round_trip").alias("round_trip"))


def op4_slot_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_map.assign(_table(spark, sf_dir, "documents"))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.delete_repeated_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"))


def op5_whole_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.delete_repeated_runs(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)
    return kept.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"))


def op6_credential_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = cross_parsing.identify(documents)
    held_out = F.coalesce(cross_parsing.fold(F.col("doc_id")) == cross_parsing.HELD_OUT, F.lit(False))
    return predicted.select(
        "doc_id", held_out.alias("held_out"), F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"))


def op9_legacy_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy_archive.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(_table(spark, sf_dir, "documents"), keep_text=False)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


QUERIES = {
    "op1_template_leaks": op1_template_leaks,
    "op1_verbatim_leaks": op1_verbatim_leaks,
    "op2_robust_outliers": op2_robust_outliers,
    "op3_nbest_pieces": op3_nbest_pieces,
    "op4_slot_map": op4_slot_map,
    "op5_line_runs": op5_line_runs,
    "op5_whole_line_runs": op5_whole_line_runs,
    "op6_credential_grammar": op6_credential_grammar,
    "op7_order_minhash": op7_order_minhash,
    "op8_cross_parsing": op8_cross_parsing,
    "op9_legacy_archive": op9_legacy_archive,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_rules": op13_url_rules,
}
