"""The numbered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import chat_format, exact_dedup, fill_middle, lm_score, media, mixing, near_dedup, secret_scan, sentencepiece_codec, substring_dedup, toxicity, url_filter, vector_codes
from llm._common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_odd_conversation(table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_chats(chat_format.log_of(rows)))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.per_document(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), width=2, percent=80)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_toxicity, op2_url_filter, op3_mix_sources, op4_lm_score, op5_chat_format, op6_sentencepiece, op7_secret_scan,
        op8_exact_dedup, op9_near_dedup, op10_media, op11_fill_in_middle, op12_vector_codes, op13_substring_dedup,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": url_filter.SQL, "op3_mix_sources": mixing.SQL, "op5_chat_format": chat_format.SQL, "op8_exact_dedup": exact_dedup.SQL,
        "op11_fill_in_middle": fill_middle.SQL, "op12_vector_codes": vector_codes.SQL, "op13_substring_dedup": substring_dedup.SQL,
    }
