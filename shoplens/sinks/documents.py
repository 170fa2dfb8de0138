"""Daily document sink for matched payments (K2-K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.dates import day_string

# document fields and their names in the target (fixed values)
FIELDS = {
    "tx_id": "txId",
    "order_id": "orderId",
    "event_type": "eventType",
    "order_time": "orderTime",
    "pay_channel": "payChannel",
    "receipt_time": "receiptTime",
}


def document_rows(matched: DataFrame) -> DataFrame:
    """K2: one document per matched pair, with the order day and an id that a replay repeats."""
    identity = F.concat_ws("|", "tx_id", "order_id", "order_time", "receipt_time")
    return matched.select(
        *(F.col(name).alias(target) for name, target in FIELDS.items()),
        day_string(F.col("order_time") * 1000).alias("day"),
        F.sha2(identity, 256).alias("doc_id"))
