"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before
it kept.  What a stage returns is written as Parquet to the shared folder and read
again, so lineage is cut there and a lost executor costs one stage at most.

Defined results: a null or empty text fails the quality rules and goes there; a stage
given one by itself keeps it like any other document (an empty line, no window, the end
token alone).  Null ids stay; repeated rows are one document to near-dedup, which keeps
one of them.  Texts of any length are taken whole.  No documents give no rows, with the
same columns.  Further columns are passed through by all stages but the last, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import decontam, linededup, minhash, packing, quality
from shoplens.llm.common import keep, table

#: The result holds token ids' check sums, which SQL cannot make; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; a document that loses all keeps an empty text."""
    kept = linededup.dedup_lines(spark, docs).drop(*linededup.ADDED)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays."""
    return minhash.distinct_documents(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(spark, stage(spark, docs, sf_dir), name)
    return docs
