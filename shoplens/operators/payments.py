"""Payments against receipts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.filters import has_transaction
from shoplens.operators.windows import floor_div

# widths of the time slices that split one transaction id over many tasks: for pairs, and for chains
SLICE_S, CHAIN_SLICE_S = 60, 600


class Reconciled(NamedTuple):
    matched: DataFrame
    unmatched_pays: DataFrame
    unmatched_receipts: DataFrame


def _joinable() -> Column:
    return F.col("tx_id").isNotNull() & (F.col("tx_id") != "")


def _sliced(df: DataFrame) -> DataFrame:
    return df.withColumn("_slice", floor_div("timestamp", SLICE_S))


def _spread(df: DataFrame, before_s: int, after_s: int, slice_s: int = SLICE_S) -> DataFrame:
    """A copy of the row for every slice that its partners' times can fall in."""
    first = floor_div(F.col("timestamp") - before_s, slice_s)
    last = floor_div(F.col("timestamp") + after_s, slice_s)
    return df.withColumn("_slice", F.explode(F.sequence(first, last)))


def pay_receipt_interval_join(pays: DataFrame, receipts: DataFrame,
                              before_s: int = 3, after_s: int = 5) -> DataFrame:
    """All pairs of one transaction with the receipt in [pay - before, pay + after].

    The join key is (tx_id, time slice): a pay lives in one slice, a receipt is
    copied to the one or two it can match, so no pair is made twice, and a
    frequent transaction id never becomes one task.
    """
    left = _sliced(pays.where(has_transaction() & _joinable())).select(
        "tx_id", "_slice", "order_id", "event_type", F.col("timestamp").alias("order_time"))
    right = _spread(receipts.where(_joinable()), after_s, before_s).select(
        "tx_id", "_slice", "pay_channel", F.col("timestamp").alias("receipt_time"))
    gap = F.col("receipt_time") - F.col("order_time")
    return left.join(right, ["tx_id", "_slice"]).where(gap.between(-before_s, after_s)).select(
        "tx_id", "order_id", "event_type", "order_time", "pay_channel", "receipt_time")


def _chained(pays: DataFrame, receipts: DataFrame, before_s: int, after_s: int, slice_s: int) -> DataFrame:
    """Rows of both sides along each transaction and slice: linked to the row before or after them, and their place.

    ``_nth`` numbers the rows of a slice; ``_base`` is the number of the last row not linked
    to the one before it, null while the slice goes on with a chain of the slice before.
    """
    pay, rec = F.struct("order_id", "event_type", "timestamp"), F.struct("pay_channel", "timestamp")
    kind_of = lambda df, column: df.select(column.alias("c")).schema["c"].dataType
    none = F.lit(None)
    rows = pays.select("tx_id", "timestamp", F.lit(False).alias("_receipt"), pay.alias("_pay"),
                       none.cast(kind_of(receipts, rec)).alias("_rec")).unionByName(
        receipts.select("tx_id", "timestamp", F.lit(True).alias("_receipt"),
                        none.cast(kind_of(pays, pay)).alias("_pay"), rec.alias("_rec")))

    reach = max(before_s, after_s)
    along = Window.partitionBy("tx_id", "_slice").orderBy("timestamp", "_receipt", "_pay", "_rec")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    gap = lambda first, second: F.col(f"{second}.at") - F.col(f"{first}.at")
    link = lambda first, second: F.coalesce(
        (F.col(f"{first}.receipt") != F.col(f"{second}.receipt"))
        & (gap(first, second) <= F.when(F.col(f"{second}.receipt"), after_s).otherwise(before_s)), F.lit(False))
    me = F.struct(F.col("timestamp").alias("at"), F.col("_receipt").alias("receipt"), "_pay", "_rec")
    near = _spread(rows, reach, reach, slice_s).withColumn("_me", me).withColumn(
        "_own", F.col("_slice") == floor_div("timestamp", slice_s))
    near = near.select("*", F.lag("_me").over(along).alias("_prev"), F.lead("_me").over(along).alias("_next"),
                       F.lead("_own").over(along).alias("_goes_on"), F.sum(F.col("_own").cast("int")).over(so_far).alias("_nth"))
    near = near.withColumn("_linked", link("_prev", "_me")).withColumn("_more", link("_me", "_next"))
    base = F.last(F.when(F.col("_own") & ~F.col("_linked"), F.col("_nth")), ignorenulls=True).over(so_far)
    return near.withColumn("_base", base).where("_own").drop("_me", "_next", "_own")


def _carried(chained: DataFrame) -> DataFrame:
    """Per transaction and slice that goes on with a chain: ``_before``, the rows of that chain after its first.

    Only slices whose chains cross a border take part, with one row each.
    """
    ends = chained.where(~F.coalesce("_goes_on", F.lit(False)))  # the last row of a slice
    digest = ends.where("_more").select(
        "tx_id", "_slice", F.col("_nth").alias("_n"), F.col("_base").isNull().alias("_whole"),
        F.coalesce(F.col("_nth") - F.col("_base"), F.lit(0)).alias("_tail"))
    along = Window.partitionBy("tx_id").orderBy("_slice")
    total = F.sum("_n").over(along)
    start = F.last(F.when(~F.col("_whole"), total - F.col("_tail")), ignorenulls=True).over(along)
    return digest.select("tx_id", (F.col("_slice") + 1).alias("_slice"), (total - start).alias("_before"))


def pay_receipt_match(pays: DataFrame, receipts: DataFrame, before_s: int = 3, after_s: int = 5,
                      slice_s: int = CHAIN_SLICE_S) -> Reconciled:
    """Pays and receipts matched one to one, and those of either side left waiting.

    Along the rows of a transaction (pays before receipts in one second), a row closes a
    pair with the one before it if that is of the other side, waits, and is close enough:
    a receipt up to ``after_s`` after its pay, a pay up to ``before_s`` after its receipt.
    Rows so linked form chains that pair up two by two, so every row is used once.  Rows
    without an id do not take part and are left over.

    One exchange by transaction and slice of time serves neighbours and places; what crosses
    the border of a slice is carried by one row for each such slice.
    """
    paid = pays.where(has_transaction())
    rows = _chained(paid.where(_joinable()), receipts.where(_joinable()), before_s, after_s, slice_s)
    placed = rows.join(_carried(rows), ["tx_id", "_slice"], "left")
    since = F.col("_nth") - F.coalesce("_base", -F.coalesce("_before", F.lit(0)))
    odd = since % 2 == 1
    pay, rec = F.coalesce("_pay", "_prev._pay"), F.coalesce("_rec", "_prev._rec")
    matched = placed.where(odd).select(
        "tx_id", pay["order_id"].alias("order_id"), pay["event_type"].alias("event_type"),
        pay["timestamp"].alias("order_time"), rec["pay_channel"].alias("pay_channel"), rec["timestamp"].alias("receipt_time"))
    alone = placed.where(~odd & ~F.col("_more"))
    pays_left = alone.where("NOT _receipt").select("_pay.order_id", "_pay.event_type", "tx_id", "timestamp")
    receipts_left = alone.where("_receipt").select("tx_id", "_rec.pay_channel", "timestamp")
    return Reconciled(
        matched,
        pays_left.unionByName(paid.where(~_joinable()).select(*pays_left.columns)),
        receipts_left.unionByName(receipts.where(~_joinable()).select(*receipts_left.columns)),
    )
