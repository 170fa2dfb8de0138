"""Streaming forms of the window counts.  Inputs carry a watermarked ``ts`` column.

Tumbling windows are plain DataFrame plans: Spark keeps the state and drops it behind the
watermark.  Sliding windows and running counts keep theirs in ``panes.py``, which counts a
late row in every window that is still open.  Append mode gives a window once, when it
closes; update mode gives every change, for sinks that replace by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.dates import window_end_string
from shoplens.functions.filters import constant_key, is_get, is_installed, is_page, is_page_view, salt
from shoplens.streaming.panes import mark_late, rank_changes, running_views, running_visitors, sliding_counts


def kept(df: DataFrame, condition: Column) -> DataFrame:
    """Filter above the watermark.

    Spark moves a filter below the watermark, and then only the rows it keeps
    advance event time.  A condition that mentions ``ts`` stays where it is, so
    windows close by the time of all rows.
    """
    return df.where(F.when(F.col("ts").isNotNull(), condition))


def _named(counts: DataFrame, keys: list[str], window: str = "window") -> DataFrame:
    return counts.select(*keys, F.unix_millis(f"{window}.end").alias("window_end"), "count")


def tumbling_count(df: DataFrame, keys: list[str], size: str) -> DataFrame:
    return _named(df.groupBy(*keys, F.window("ts", size)).count(), keys)


def hot_item_counts(behavior: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                    every_version: bool = False, lateness: str = "0 seconds") -> DataFrame:
    """A1, append mode."""
    return sliding_counts(kept(behavior, is_page_view()), ["item_id"], size, slide, lateness, every_version)


def hot_page_versions(log: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
                      lateness: str = "1 minute") -> DataFrame:
    """A5, append mode: the counts of closed windows, and again whenever a late view corrects one, with the count before."""
    return sliding_counts(kept(log, is_get() & is_page()), ["url"], size, slide, lateness, every_version=True)


def hot_item_ranks(behavior: DataFrame, size: str = "1 hour", slide: str = "5 minutes", n: int = 5,
                   lateness: str = "0 seconds") -> DataFrame:
    """A3, append mode: the ranks of each window as a retract stream."""
    return rank_changes(hot_item_counts(behavior, size, slide, True, lateness), "item_id", n, lateness)


def marked_views(log: DataFrame, size: str = "10 minutes", slide: str = "5 seconds", lateness: str = "1 minute") -> DataFrame:
    """A6, append mode: page views with ``late``, true where no window takes them any more."""
    return mark_late(kept(log, is_get() & is_page()), size, slide, lateness)


def pv_per_record(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """A12, append mode: the running count of a window, one row for each view."""
    return running_views(kept(behavior, is_page_view()), size)


def uv_running(behavior: DataFrame, size: str = "1 hour", bits: int = 29, seed: int = 61) -> DataFrame:
    """A11, append mode: the running visitor count of a window, one row for each new bit."""
    return running_visitors(kept(behavior, is_page_view()), size, bits, seed)


def pv_tumbling(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """A8."""
    return tumbling_count(kept(behavior, is_page_view()), [], size).select(
        constant_key("pv", "url"), "window_end", "count")


def pv_salted(behavior: DataFrame, size: str = "1 hour", salts: int = 10) -> DataFrame:
    """A9, append mode: counts per salt, then their sum per window."""
    salted = kept(behavior, is_page_view()).withColumn(
        "salt", salt("user_id", "item_id", "timestamp", salts=salts))
    parts = salted.groupBy("salt", F.window("ts", size)).agg(F.count("*").alias("n"))
    total = parts.groupBy(F.window(F.window_time("window"), size)).agg(F.sum("n").alias("count"))
    return total.select(constant_key("pv", "url"), F.unix_millis("window.end").alias("window_end"), "count")


def uv_exact(behavior: DataFrame, size: str = "1 hour") -> DataFrame:
    """A10, append mode: each (window, user) once, then a count."""
    seen = kept(behavior, is_page_view()).select(F.window("ts", size).alias("w"), "user_id")
    counted = seen.dropDuplicates(["w", "user_id"]).groupBy("w").count()
    return _named(counted, [], "w").select(constant_key("uv", "url"), "window_end", "count")


def uv_sketches(behavior: DataFrame, size: str = "1 hour", lg_k: int = 12) -> DataFrame:
    """A13, update mode: the current visitor sketch of each window; see ``uv_from_sketches``."""
    sketched = kept(behavior, is_page_view()).groupBy(F.window("ts", size)).agg(
        F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("sketch"))
    return sketched.select(F.unix_millis("window.end").alias("window_end"), "sketch")


def marketing_total(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """A14, append mode."""
    counts = sliding_counts(kept(events, is_installed()), [], size, slide)
    return counts.select(constant_key("total", "channel"), constant_key("total", "behavior"),
                         window_end_string("window_end").alias("window_end"), "count")


def marketing_by_channel(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """A15, append mode."""
    counts = sliding_counts(kept(events, is_installed()), ["channel", "behavior"], size, slide)
    return counts.select("channel", "behavior", window_end_string("window_end").alias("window_end"), "count")


def ad_count_by_province(passed: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """A19, append mode, on the rows the click cap let through."""
    counts = sliding_counts(passed, ["province"], size, slide)
    return counts.select("province", window_end_string("window_end").alias("window_end"), "count")
