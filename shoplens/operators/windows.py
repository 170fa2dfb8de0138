"""Event-time window counts on batch DataFrames.

Times are epoch seconds; a window is named by its end in epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def to_seconds(text: str) -> int:
    """``"1 hour"`` -> 3600."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def floor_to(column: Column | str, step: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column - F.pmod(column, F.lit(step))


def floor_div(column: Column | str, step: int) -> Column:
    """Whole steps below the value, also for values below zero."""
    return F.call_function("div", floor_to(column, step), F.lit(step))


def tumbling_end(size: str, column: str = "timestamp") -> Column:
    """End of the tumbling window of a row, in milliseconds."""
    step = to_seconds(size)
    return ((floor_to(column, step) + step) * 1000).alias("window_end")


def tumbling_count(df: DataFrame, keys: list[str], size: str) -> DataFrame:
    return df.groupBy(*keys, tumbling_end(size)).agg(F.count("*").alias("count"))


def sliding_count(df: DataFrame, keys: list[str], size: str, slide: str) -> DataFrame:
    """Rows per key and sliding window -> keys, ``window_end``, ``count``.

    A row lies in size/slide windows, so expanding rows would multiply the
    shuffle.  Instead rows are counted per slide-long pane (combined on the map
    side, which also flattens hot keys), each pane becomes a step up at its first
    window and a step down after its last, and a running sum over the steps gives
    the counts.  Only the result is expanded.  Steps are cut at fixed time spans,
    so one key is worked on by many tasks.
    """
    slide_s = to_seconds(slide)
    panes = df.groupBy(*keys, floor_to("timestamp", slide_s).alias("_pane")).agg(F.count("*").alias("_n"))
    return sliding_from_panes(panes, keys, size, slide)


def sliding_from_panes(panes: DataFrame, keys: list[str], size: str, slide: str, first: str | None = None) -> DataFrame:
    """:func:`sliding_count` of rows already counted as ``_n`` per key and ``_pane`` (its first second).

    A column ``first`` may name the end of the first window that these rows still reach.
    """
    size_s, slide_s = to_seconds(size), to_seconds(slide)
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    span = 24 * size_s

    first_end, last_end = F.col("_pane") + slide_s, F.col("_pane") + size_s
    if first:
        first_end = F.greatest(first_end, F.col(first))
        panes = panes.where(first_end <= last_end)
    placed = panes.withColumn(
        "_span", F.explode(F.sequence(floor_div(first_end, span), floor_div(last_end, span))))
    up = F.struct(F.greatest(first_end, F.col("_span") * span).alias("at"), F.col("_n").alias("by"))
    down = F.struct(F.least(last_end + slide_s, (F.col("_span") + 1) * span).alias("at"),
                    (-F.col("_n")).alias("by"))
    steps = (
        placed.repartition(*keys, "_span")
        .select(*keys, "_span", F.explode(F.array(up, down)).alias("_step"))
        .select(*keys, "_span", "_step.at", "_step.by")
    )
    ordered = Window.partitionBy(*keys, "_span").orderBy("at")
    level = steps.select(
        *keys, "at",
        F.sum("by").over(ordered).alias("count"),
        F.lead("at").over(ordered).alias("_until"),
    )
    ends = F.explode(F.sequence(F.col("at"), F.col("_until") - slide_s, F.lit(slide_s).cast("bigint")))
    return (
        level.where((F.col("count") > 0) & (F.col("_until") > F.col("at")))
        .select(*keys, ends.alias("_end"), "count")
        .select(*keys, (F.col("_end") * 1000).alias("window_end"), "count")
    )
