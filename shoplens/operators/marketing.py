"""App marketing counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplens.functions.dates import window_end_string
from shoplens.functions.filters import constant_key, is_installed
from shoplens.operators.windows import sliding_count


def marketing_total(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """All channels and behaviours but uninstalls, under the key ``total``."""
    counts = sliding_count(events.where(is_installed()), [], size, slide)
    return counts.select(
        constant_key("total", "channel"), constant_key("total", "behavior"),
        window_end_string("window_end").alias("window_end"), "count")


def marketing_by_channel(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Per channel and behaviour; a null behaviour is a group of its own."""
    counts = sliding_count(events.where(is_installed()), ["channel", "behavior"], size, slide)
    return counts.select("channel", "behavior", window_end_string("window_end").alias("window_end"), "count")
