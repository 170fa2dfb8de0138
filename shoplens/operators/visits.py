"""Page views and unique visitors per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.bitmap import bit_offset
from shoplens.functions.filters import constant_key, is_page_view, salt
from shoplens.operators.ordered import RANGE_BITS, running_count
from shoplens.operators.windows import tumbling_count, tumbling_end


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.select(constant_key(label, "url"), "window_end", "count")


def pv_tumbling(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """Page views per window.  One row per task and window is shuffled."""
    return _labelled(tumbling_count(behavior.where(is_page_view()), [], size), "pv")


def pv_salted(behavior: DataFrame, size: str = "1 hour", salts: int = 10) -> DataFrame:
    """The same in two phases, per salt and then per window."""
    salted = behavior.where(is_page_view()).withColumn(
        "_salt", salt("user_id", "item_id", "timestamp", salts=salts))
    parts = tumbling_count(salted, ["_salt"], size)
    return _labelled(parts.groupBy("window_end").agg(F.sum("count").alias("count")), "pv")


def uv_exact(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """A10: distinct visitors per window, made unique per (window, user) before counting."""
    views = behavior.where(is_page_view()).select(tumbling_end(size), "user_id")
    return _labelled(views.groupBy("window_end").agg(F.count_distinct("user_id").alias("count")), "uv")


def uv_bloom_running(behavior: DataFrame, tie: str, size: str = "1 hour", bits: int = 29,
                     seed: int = 61, range_bits: int = RANGE_BITS) -> DataFrame:
    """The running visitor count of a window at every first use of a bit.

    The first arrival of each bit is found by aggregation, and only those rows
    are numbered.
    """
    first = (
        behavior.where(is_page_view())
        .groupBy(tumbling_end(size), bit_offset("user_id", bits, seed).alias("_bit"))
        .agg(F.min(tie).alias("_first"))
        .select("window_end", "_first")
    )
    return _labelled(running_count(first, ["window_end"], "_first", bits=range_bits), "uv")


def pv_per_record(behavior: DataFrame, tie: str, size: str = "1 hour",
                  range_bits: int = RANGE_BITS) -> DataFrame:
    """Fire on every record: the running page-view count of its window."""
    views = behavior.where(is_page_view()).select(tumbling_end(size), F.col(tie))
    counted = running_count(views, ["window_end"], tie, bits=range_bits)
    return counted.select(constant_key("pv", "url"), "window_end", tie, "count")


def uv_so_far(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """Distinct visitors of all windows up to each, exactly: every visitor counts in the first window that saw them."""
    views = behavior.where(is_page_view()).select(tumbling_end(size), "user_id")
    new = views.groupBy("user_id").agg(F.min("window_end").alias("window_end")).groupBy("window_end").agg(
        F.count("*").alias("_new"))
    ends = views.select("window_end").distinct().join(new, "window_end", "left")
    running = F.sum(F.coalesce("_new", F.lit(0))).over(Window.orderBy("window_end"))  # one row per window
    return ends.select(constant_key("uv", "url"), "window_end", running.alias("count"))


def within(estimates: DataFrame, exact: DataFrame, error: float = 0.05) -> DataFrame:
    """Exact counts, and whether the estimate of the same window lies within a relative ``error``."""
    near = F.abs(F.col("estimate") - F.col("count")) <= error * F.col("count")
    return exact.join(estimates.withColumnRenamed("count", "estimate"), ["url", "window_end"]).select(
        "url", "window_end", "count", near.alias("close"))


def uv_hll(behavior: DataFrame, size: str = "1 hour", per_window: bool = False,
           lg_k: int = 12) -> DataFrame:
    """Approximate visitors, over all windows so far or per window.

    One sketch per window leaves the aggregation; only these sketches meet in
    the cumulative union.
    """
    sketches = (
        behavior.where(is_page_view())
        .groupBy(tumbling_end(size))
        .agg(F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("_sketch"))
    )
    if not per_window:
        so_far = Window.orderBy("window_end").rowsBetween(Window.unboundedPreceding, 0)
        sketches = sketches.withColumn("_sketch", F.hll_union_agg("_sketch").over(so_far))
    return _labelled(sketches.withColumn("count", F.hll_sketch_estimate("_sketch")), "uv")
