"""Ad clicks with a per-user cap."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens import outcomes
from shoplens.functions.dates import window_end_string
from shoplens.operators.windows import floor_div, sliding_count
from shoplens.scratch import written


class CappedClicks(NamedTuple):
    passed: DataFrame
    warnings: DataFrame


def cap_clicks(clicks: DataFrame, tie: list[str], cap: int = 100, cycle_s: int = 86400) -> CappedClicks:
    """The first ``cap`` clicks of a user on an ad per cycle, and one warning beyond.

    The cycle is the UTC day of the click.  Both outputs bound the row number, so
    Spark keeps at most cap + 1 rows per (user, ad, cycle) and task before the
    exchange, however many clicks a pair has.
    """
    return _capped(clicks.withColumn("_cycle", floor_div("timestamp", cycle_s)), tie, cap)


PAIR = ["user_id", "ad_id"]


def _same_pair(other: DataFrame, *names: str) -> tuple[DataFrame, Column]:
    """``other`` with its pair renamed, and the condition that it is the same; null ids are ids like others."""
    renamed = other.select(*(F.col(k).alias(f"_{k}") for k in PAIR), *names)
    return renamed, F.col("user_id").eqNullSafe(F.col("_user_id")) & F.col("ad_id").eqNullSafe(F.col("_ad_id"))


def _following(seconds: DataFrame, cycle_s: int) -> DataFrame:
    """For every second of a pair the first one ``cycle_s`` or more after it (null without one).

    It lies in the next slice of ``cycle_s`` seconds, or is the first of the next slice after
    that; so a slice needs its own seconds, those of the next, and one row per slice.
    """
    sliced = seconds.withColumn("_slice", floor_div("_at", cycle_s))
    heads = sliced.groupBy(*PAIR, "_slice").agg(F.min("_at").alias("_head"))
    along = Window.partitionBy(*PAIR).orderBy("_slice")  # a row per pair and day
    beyond = F.when(F.lead("_slice").over(along) > F.col("_slice") + 1, F.lead("_head").over(along)).otherwise(
        F.lead("_head", 2).over(along))
    heads = heads.select(*PAIR, "_slice", beyond.alias("_beyond"))
    own = sliced.select(*PAIR, "_slice", "_at", F.lit(True).alias("_own"))
    of_next = sliced.select(*PAIR, (F.col("_slice") - 1).alias("_slice"), "_at", F.lit(False).alias("_own"))
    later = Window.partitionBy(*PAIR, "_slice").orderBy("_at").rangeBetween(cycle_s, Window.unboundedFollowing)
    near = own.unionByName(of_next).withColumn("_near", F.min("_at").over(later)).where("_own")
    named, same = _same_pair(heads, F.col("_slice").alias("_of"), "_beyond")
    return near.join(named, same & (F.col("_slice") == F.col("_of"))).select(
        *PAIR, "_at", F.coalesce("_near", "_beyond").alias("_next"))


def _starts(clicks: DataFrame, cycle_s: int) -> DataFrame:
    """``_at`` of the first click of every cycle of a pair, by pointer doubling.

    In round i all seconds know the start 2**i cycles on, and the starts found double; the
    tables of a round are written, so the plan does not grow with the rounds.
    """
    spark = clicks.sparkSession
    seconds = clicks.select(*PAIR, F.col("timestamp").cast("bigint").alias("_at")).where("_at IS NOT NULL").distinct()
    # written: else a task of the union below makes the rows distinct twice at a time
    seconds = written(spark, seconds, "seconds")
    jump = written(spark, _following(seconds, cycle_s), "jumps")
    found = jump.groupBy(*PAIR).agg(F.min("_at").alias("_at"))
    while True:
        named, same = _same_pair(jump, F.col("_at").alias("_from"), "_next")
        ahead = found.join(named, same & (F.col("_at") == F.col("_from"))).where("_next IS NOT NULL")
        ahead = written(spark, ahead.select(*PAIR, F.col("_next").alias("_at")), "starts")
        if ahead.isEmpty():
            return found
        found = written(spark, found.unionByName(ahead), "starts")
        step = jump.join(named.withColumnRenamed("_next", "_far"), same & (F.col("_next") == F.col("_from")))
        jump = written(spark, step.select(*PAIR, "_at", F.col("_far").alias("_next")), "jumps")


def cap_clicks_from_first(clicks: DataFrame, tie: list[str], cap: int = 100, cycle_s: int = 86400) -> CappedClicks:
    """A18 with cycles that start at a click: the first of a user on an ad, then the first ``cycle_s`` or more after a start.

    Starts are at least a cycle apart, so a slice of ``cycle_s`` seconds holds one at most,
    and the start that a click belongs to lies in its own slice or the one before.
    """
    starts = written(clicks.sparkSession, _starts(clicks, cycle_s).withColumn("_of", floor_div("_at", cycle_s)), "starts")
    here = starts.select(*PAIR, "_of", F.col("_at").alias("_here"), F.lit(None).cast("bigint").alias("_before"))
    after = starts.select(*PAIR, (F.col("_of") + 1).alias("_of"), F.lit(None).cast("bigint").alias("_here"), F.col("_at").alias("_before"))
    reach = here.unionByName(after).groupBy(*PAIR, "_of").agg(F.max("_here").alias("_here"), F.max("_before").alias("_before"))
    named, same = _same_pair(reach, "_of", "_here", "_before")
    cycle = F.when(F.col("_here") <= F.col("timestamp"), F.col("_here")).otherwise(F.col("_before"))
    placed = clicks.withColumn("_slice", floor_div("timestamp", cycle_s)).join(
        written(clicks.sparkSession, named, "starts"), same & (F.col("_slice") == F.col("_of")))
    return _capped(placed.withColumn("_cycle", cycle).drop("_user_id", "_ad_id", "_of", "_slice", "_here", "_before"), tie, cap)


def _capped(clicks: DataFrame, tie: list[str], cap: int) -> CappedClicks:
    """The first ``cap`` clicks of each ``_cycle``, and a warning for the next."""
    numbered = clicks.withColumn(
        "_nth", F.row_number().over(
            Window.partitionBy("user_id", "ad_id", "_cycle").orderBy("timestamp", *tie)))
    passed = numbered.where(F.col("_nth") <= cap).drop("_nth", "_cycle")
    warnings = numbered.where(F.col("_nth") == cap + 1).select(
        "user_id", "ad_id", F.lit(outcomes.click_warning(cap)).alias("warning_msg"))
    return CappedClicks(passed, warnings)


def ad_count_by_province(passed: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Clicks per province and sliding window."""
    counts = sliding_count(passed, ["province"], size, slide)
    return counts.select("province", window_end_string("window_end").alias("window_end"), "count")
