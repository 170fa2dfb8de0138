"""The queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shoplens.llm import (
    chat, decontam, kneserney, licenses, linededup, minhash, packing, quality, secrets, spelling, tokencount, vectorcodes, warc)
from shoplens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_histories(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokencount.recounted(docs, tokencount.sample_edits(docs))


def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(spark, table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.sha2(text, 256).alias("kept_sha256"))


def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicate_classes(spark, table(spark, sf_dir, "documents"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_anywhere(table(spark, sf_dir, "documents"))


def _secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark, table(spark, sf_dir, "documents"))


def _chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(spark, table(spark, sf_dir, "conversations"))


def _lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.held_out_scores(spark, table(spark, sf_dir, "documents"))


def _spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def _vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(spark, table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_warc_index_merge": _warc,
        "op2_token_counts": _token_counts,
        "op3_quality_rules": _quality_rules,
        "op4_line_dedup": _line_dedup,
        "op5_minhash_near_dedup": _near_dedup,
        "op6_decontamination": _decontamination,
        "op7_best_fit_packing": _packing,
        "op8_license_scan": _license_scan,
        "op9_secret_scan": _secret_scan,
        "op10_chat_formatting": _chat_formatting,
        "op11_lm_scoring": _lm_scoring,
        "op12_spelling_variants": _spelling_variants,
        "op13_vector_codes": _vector_codes,
        "pipeline": corpus_pipeline.run,
    }
