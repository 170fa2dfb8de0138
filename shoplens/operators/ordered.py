"""Running values over a long order, without one task seeing the whole order.

The order column is a unique BIGINT, such as an arrival number.  Rows are cut
into ranges of 2**bits order values, so a range holds at most that many rows.
One small row per range carries the value of all ranges before it; within a
range an ordinary window finishes the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 20
_COARSE_BITS = 10


def _in_ranges(df: DataFrame, order: str, bits: int) -> DataFrame:
    """Add the range of a row and the group of 1024 ranges it belongs to.

    Stating that both are known keeps the optimizer from adding that filter to
    some uses of the result only, so Spark can reuse one exchange for all.
    """
    ranged = df.withColumn("_range", F.shiftright(order, bits)).withColumn(
        "_coarse", F.shiftright(order, bits + _COARSE_BITS))
    return ranged.where("_range IS NOT NULL AND _coarse IS NOT NULL")


def _carry(per_range: DataFrame, keys: list[str], value: str, combine) -> DataFrame:
    """Per key and ``_range``: the combined ``value`` of earlier ranges.

    ``_inner`` covers the ranges of the same coarse group and ``_base`` the groups
    before it, so the widest window sees one row per 2**(bits + 10) order values.
    """
    def earlier(by: list[str], order: str):
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    heads = per_range.groupBy(*keys, "_coarse").agg(combine(value).alias("_head"))
    heads = heads.select(*keys, "_coarse", combine("_head").over(earlier(keys, "_coarse")).alias("_base"))
    inner = per_range.withColumn("_inner", combine(value).over(earlier([*keys, "_coarse"], "_range")))
    return inner.join(heads, [*keys, "_coarse"]).select(*keys, "_coarse", "_range", "_base", "_inner")


def running_count(df: DataFrame, keys: list[str], order: str, out: str = "count",
                  bits: int = RANGE_BITS) -> DataFrame:
    """Number the rows of every key along ``order``, from 1."""
    ranged = _in_ranges(df, order, bits)
    totals = ranged.groupBy(*keys, "_coarse", "_range").agg(F.count("*").alias("_n"))
    carry = _carry(totals, keys, "_n", F.sum)
    local = F.row_number().over(Window.partitionBy(*keys, "_coarse", "_range").orderBy(order))
    before = F.coalesce("_base", F.lit(0)) + F.coalesce("_inner", F.lit(0))
    return (
        ranged.withColumn("_local", local)
        .join(carry, [*keys, "_coarse", "_range"])
        .withColumn(out, F.col("_local") + before)
        .drop("_range", "_coarse", "_local", "_base", "_inner")
    )


def max_before(df: DataFrame, value: str, order: str, out: str,
               bits: int = RANGE_BITS, keys: list[str] | None = None) -> DataFrame:
    """Largest ``value`` among all rows (of the key) earlier in ``order``; null for the first row."""
    by = [*(keys or []), "_coarse", "_range"]
    ranged = _in_ranges(df, order, bits)
    tops = ranged.groupBy(*by).agg(F.max(value).alias("_top"))
    carry = _carry(tops, keys or [], "_top", F.max)
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local: Column = F.max(value).over(earlier)
    return (
        ranged.withColumn("_local", local)
        .join(carry, by)
        .withColumn(out, F.greatest("_local", "_base", "_inner"))
        .drop("_range", "_coarse", "_local", "_base", "_inner")
    )
