"""What several operators share: table access, text as bytes, document keys, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.plans.scratch import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a table that outlives executors, and what is used
    twice afterwards is computed once.
    """
    path = scratch_dir(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes() -> Column:
    """The whole text as UTF-8; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


#: Identifies a document by id and text, so null and repeated ids do no harm.  Rows that
#: agree in both are the same document to every operator and get the same decision.
KEY = ["_k1", "_k2"]


def row_key() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("_k2")]


def own_columns(docs: DataFrame, added: list[str]) -> list[Column]:
    """The columns of ``docs`` but those that an operator's own would clash with."""
    taken = {name.lower() for name in added}
    return [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what Python makes of long texts stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def binaries(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()

