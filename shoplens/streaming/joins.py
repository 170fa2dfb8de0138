"""Streaming joins: payments with receipts.

Both inputs carry a watermarked ``ts``; the interval bounds the join state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.filters import has_transaction
from shoplens.streaming import processors
from shoplens.streaming.windows import kept


def _sides(pays: DataFrame, receipts: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = kept(pays, has_transaction()).select(
        "tx_id", "order_id", "event_type", F.col("timestamp").alias("order_time"), F.col("ts").alias("pay_ts"))
    right = receipts.select(
        F.col("tx_id").alias("receipt_tx"), "pay_channel", F.col("timestamp").alias("receipt_time"),
        F.col("ts").alias("receipt_ts"))
    return left, right


def _within(before_s: int, after_s: int):
    return F.expr(f"""tx_id = receipt_tx
        AND receipt_ts >= pay_ts - INTERVAL {int(before_s)} SECONDS
        AND receipt_ts <= pay_ts + INTERVAL {int(after_s)} SECONDS""")


def interval_join(pays: DataFrame, receipts: DataFrame, before_s: int = 3, after_s: int = 5) -> DataFrame:
    """J4."""
    left, right = _sides(pays, receipts)
    return left.join(right, _within(before_s, after_s)).select(
        "tx_id", "order_id", "event_type", "order_time", "pay_channel", "receipt_time")


def reconcile(pays: DataFrame, receipts: DataFrame, before_s: int = 3, after_s: int = 5) -> DataFrame:
    """J1-J3 in one pass, one to one: ``outcome`` is matched, unmatched-pay or unmatched-receipt.

    Rows come out once the watermark has passed them, unmatched ones once it says no
    partner can follow.  Rows without an id have none and do not go into the state.
    """
    known = F.col("tx_id").isNotNull() & (F.col("tx_id") != "")
    none = lambda kind: F.lit(None).cast(kind)
    left = lambda condition: pays.where(condition).select(
        "tx_id", F.lit(False).alias("is_receipt"), "order_id", "event_type", none("string").alias("pay_channel"), "timestamp", "ts")
    right = lambda condition: receipts.where(condition).select(
        "tx_id", F.lit(True).alias("is_receipt"), none("bigint").alias("order_id"), none("string").alias("event_type"),
        "pay_channel", "timestamp", "ts")
    timed = F.col("ts").isNotNull()  # mentions ``ts``, so it stays above the watermark; see ``kept``
    both = left(F.when(timed, known)).unionByName(right(F.when(timed, known)))
    matched = processors.pay_receipt_match(both, before_s, after_s)
    alone = left(F.when(timed, ~known).otherwise(True) & has_transaction()).unionByName(
        right(F.when(timed, ~known).otherwise(True)))
    at = lambda receipt: F.when(F.col("is_receipt") == receipt, F.col("timestamp"))
    columns = ["outcome", "tx_id", "order_id", "event_type", "order_time", "pay_channel", "receipt_time"]
    return matched.select(*columns).unionByName(alone.select(
        F.when(F.col("is_receipt"), "unmatched-receipt").otherwise("unmatched-pay").alias("outcome"), "tx_id", "order_id",
        "event_type", at(False).alias("order_time"), "pay_channel", at(True).alias("receipt_time")))
