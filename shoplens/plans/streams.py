"""Registered streaming queries.

The events of a query arrive in ``SLICES`` deliveries, cut by time; those of sliding windows
and of late rows in ``ARRIVALS``, cut by the second they arrive in, which is up to two hours
after their time.  After each delivery the query is started from its checkpoint and
drained, so results build up over several micro-batches and restarts; what the sink then
holds is returned.  Windows still open at the last watermark stay open.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators import hot, visits
from shoplens.plans.scratch import scratch_dir, written
from shoplens.sinks import streams as sinks
from shoplens.sinks.documents import document_rows
from shoplens.sources import decode, linelog, tables
from shoplens.sources.lines import lines_from, with_event_time
from shoplens.streaming import joins, processors, windows
from shoplens.streaming.panes import retractions

Sink = Callable[[DataFrame, str, str], StreamingQuery]


def _append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return sinks.append_sink(stream, path, checkpoint, drain=True)


def _upsert(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return sinks.upsert_sink(stream, path, checkpoint, drain=True)


STATE_PARTITIONS = "spark.shoplens.statePartitions"


@contextmanager
def _state_partitions(spark: SparkSession) -> Iterator[None]:
    """State partitions of a new query, 8 unless the session says otherwise; a checkpoint keeps its number for ever."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get(STATE_PARTITIONS, "8"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


SLICES, ARRIVALS = 3, 5


class Feed:
    """Event tables delivered as files, a slice of their common time span after the other."""

    def __init__(self, spark: SparkSession, *tables_: DataFrame, order: str = "timestamp") -> None:
        tables_ = tuple(written(spark, t, "feed-rows") for t in tables_)  # made once, not for each delivery
        self.spark, self.tables, self.order = spark, tables_, order
        self.slices = ARRIVALS if order == "arrival" else SLICES
        self.folders = [scratch_dir(spark, "feed") for _ in tables_]
        for rows, folder in zip(tables_, self.folders):  # a stream starts from a folder that is there
            rows.limit(0).write.parquet(folder)
        ends = [t.agg(F.min(order), F.max(order)).first() for t in tables_]
        self.first = min((low for low, _ in ends if low is not None), default=0)
        self.span = max((high for _, high in ends if high is not None), default=0) - self.first + 1
        highs = [high for _, high in ends]
        self.last = None if None in highs else min(highs)  # what the last watermark is counted from

    def streams(self) -> list[DataFrame]:
        return [self.spark.readStream.schema(t.schema).parquet(f) for t, f in zip(self.tables, self.folders)]

    def deliver(self, number: int) -> None:
        at = F.expr(f"(`{self.order}` - {self.first}) * {self.slices} DIV {self.span}")
        for rows, folder in zip(self.tables, self.folders):
            rows.where(at == number).write.mode("append").parquet(folder)


    def close(self) -> None:
        """A row of every table a day after all others, so that the watermark passes those."""
        for rows, folder in zip(self.tables, self.folders):
            rows.limit(1).withColumn(self.order, F.lit(self.first + self.span + 86_400)).write.mode("append").parquet(folder)


def _run(feed: Feed, start: Callable[[], StreamingQuery], close: bool = False) -> None:
    deliveries = [lambda n=number: feed.deliver(n) for number in range(feed.slices)]
    for deliver in [*deliveries, feed.close] if close else deliveries:
        deliver()
        with _state_partitions(feed.spark):
            query = start()
        query.awaitTermination()


def _drain(feed: Feed, stream: DataFrame, sink: Sink = _append, keep: bool = False, close: bool = False) -> DataFrame:
    spark = feed.spark
    folder = scratch_dir(spark, "stream")
    _run(feed, lambda: sink(stream, f"{folder}/out", f"{folder}/checkpoint"), close)
    result = spark.read.parquet(f"{folder}/out")
    return result if keep else result.drop("batch_id")


def _timed(delay: str, *tables_: DataFrame, order: str = "timestamp") -> tuple[Feed, list[DataFrame]]:
    """A feed and its streams, with event time and watermark."""
    feed = Feed(tables_[0].sparkSession, *tables_, order=order)
    return feed, [with_event_time(stream, delay) for stream in feed.streams()]


def _query(source: Callable, operator: Callable[..., DataFrame], delay: str = "200 milliseconds",
           sink: Sink = _append, keep: bool = False, order: str = "timestamp") -> Callable[[SparkSession, str], DataFrame]:
    """A registered query: the operator on the stream of one event table."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feed, (stream,) = _timed(delay, source(spark, sf), order=order)
        return _drain(feed, operator(stream), sink, keep)
    return run


def _late_query(source: Callable, operator: Callable[..., DataFrame], delay: str = "200 milliseconds",
                sink: Sink = _append, keep: bool = False, number: str = "event_id",
                fast: int = 60) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query whose events come ``fast`` times as fast, and some late, up to hours."""
    return _query(lambda spark, sf: tables.arriving(tables.rush(source(spark, sf), fast), number), operator, delay, sink, keep, "arrival")


def _top_n(spark, sf):
    return _late_query(tables.user_behavior, windows.hot_item_counts,
                       sink=lambda df, path, cp: sinks.top_n_sink(df, "item_id", path, cp, drain=True))(spark, sf)


PAGE_DELAY, PAGES_FAST = "1 second", 480


def _hot_pages(spark, sf):
    versions = _late_query(tables.access_log, windows.hot_page_versions, PAGE_DELAY, fast=PAGES_FAST)(spark, sf)
    return versions.groupBy("url", "window_end").agg(F.max("count").alias("count"))  # counts only grow


def _hot_page_changes(stream):
    return retractions(windows.hot_page_versions(stream), ["url"])


def _uv_hll(spark, sf):
    """The estimates beside the exact counts so far, and whether they are within 5 %."""
    versions = _query(tables.user_behavior, windows.uv_sketches, sink=_upsert, keep=True)(spark, sf)
    estimates = sinks.uv_from_sketches(sinks.latest(versions, ["window_end"]))
    return visits.within(estimates, visits.uv_so_far(tables.user_behavior(spark, sf)))


def _late(spark, sf):
    folder = scratch_dir(spark, "late")
    log = tables.arriving(tables.rush(tables.access_log(spark, sf), PAGES_FAST), "event_id")
    feed, (stream,) = _timed(PAGE_DELAY, log, order="arrival")
    _run(feed, lambda: sinks.late_split_sink(
        windows.marked_views(stream), f"{folder}/on_time", f"{folder}/late", f"{folder}/checkpoint", drain=True))
    sides = [spark.read.parquet(f"{folder}/{side}").drop("batch_id") for side in ("on_time", "late")]
    return sides[0].withColumn("late", F.lit(False)).unionByName(sides[1].withColumn("late", F.lit(True)))


DAY_CAP = 50  # clicks in a cycle of 24 hours; the clicks of two days reach it twice


def _capped(stream):
    return processors.cap_clicks(stream, tables.CLICK_TIE)


def _capped_split(spark, sf):
    folder = scratch_dir(spark, "capped")
    feed, (clicks,) = _timed("200 milliseconds", tables.ad_click(spark, sf))
    _run(feed, lambda: sinks.split_sink(
        _capped(clicks), {"pass": f"{folder}/passed", "warn": f"{folder}/warned"},
        f"{folder}/checkpoint", "kind", drain=True))
    return spark.read.parquet(f"{folder}/passed").drop("batch_id", "until")


def _both(spark, sf):
    return _timed("300 milliseconds", tables.order_event(spark, sf), tables.receipt(spark, sf))


def _matched(spark, sf):
    feed, (orders, receipts) = _both(spark, sf)
    return _drain(feed, joins.interval_join(orders, receipts))


def _reconcile(spark, sf):
    """All pairs, and the rows that no partner could follow by the last watermark before the feed was closed.

    One to one a pair is sure only once the watermark has passed it, so the feed is closed by a late row.
    """
    feed, (orders, receipts) = _both(spark, sf)
    rows = _drain(feed, joins.reconcile(orders, receipts), close=True)
    mark = F.lit(None if feed.last is None else feed.last * 1000 - 300)
    waited = F.coalesce(F.col("order_time") + 5, F.col("receipt_time") + 3)
    return rows.where((F.col("outcome") == "matched") | (waited * 1000 <= mark))


def _daily(spark, sf):
    folder = scratch_dir(spark, "daily")
    feed, (orders, receipts) = _both(spark, sf)
    documents = document_rows(joins.interval_join(orders, receipts))
    _run(feed, lambda: sinks.daily_sink(documents, f"{folder}/out", f"{folder}/checkpoint", drain=True))
    return sinks.published(spark, f"{folder}/out", documents.schema, "json").drop("batch_id")


def _lines_from_offset(spark, sf):
    """S3: the first delivery is there before; the stream starts at its end, and is resumed after each of the others."""
    behavior = tables.user_behavior(spark, sf)
    folder, out = scratch_dir(spark, "log"), scratch_dir(spark, "stream")
    feed = Feed(spark, behavior.select(F.concat_ws(
        ",", "user_id", "item_id", "category_id", "behavior", "timestamp").alias("value"), "timestamp"))
    at = F.expr(f"(timestamp - {feed.first}) * {SLICES} DIV {feed.span}")
    start = None
    for number in range(SLICES):
        feed.tables[0].where(at == number).select("value").write.mode("append").text(folder)
        if start is None:
            start = json.dumps(linelog.ends(folder))
            continue
        stream = decode.decode_user_behavior(lines_from(spark, folder, start, streaming=True))
        _append(stream, f"{out}/out", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/out").drop("batch_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ub, mk, clicks, orders = tables.user_behavior, tables.marketing, tables.ad_click, tables.order_event
    return {
        "stream_lines_from_offset": _lines_from_offset,
        "stream_hot_item_counts": _late_query(ub, windows.hot_item_counts),
        "stream_hot_items_top_n": _top_n,
        "stream_hot_items_sql": _late_query(ub, lambda s: windows.hot_item_ranks(s, lateness="10 minutes")),
        "stream_hot_page_counts": _hot_pages,
        "stream_hot_pages_top_n": lambda s, d: hot.top_n(_hot_pages(s, d), "url"),
        "stream_hot_page_changes": _late_query(tables.access_log, _hot_page_changes, PAGE_DELAY, fast=PAGES_FAST),
        "stream_late_split": _late,
        "stream_pv_tumbling": _query(ub, windows.pv_tumbling),
        "stream_pv_salted": _query(ub, windows.pv_salted),
        "stream_uv_exact": _query(ub, windows.uv_exact),
        "stream_uv_bloom_running": _query(ub, windows.uv_running),
        "stream_pv_per_record": _query(ub, windows.pv_per_record),
        "stream_uv_hll": _uv_hll,
        "stream_marketing_total": _late_query(mk, windows.marketing_total),
        "stream_marketing_by_channel": _late_query(mk, windows.marketing_by_channel),
        "stream_ad_clicks_capped": _capped_split,
        "stream_ad_blacklist": _query(clicks, lambda s: processors.click_warnings(_capped(s))),
        "stream_ad_blacklist_24h": _query(tables.ad_click_days, lambda s: processors.click_warnings(
            processors.cap_clicks(s, tables.CLICK_TIE, DAY_CAP, rolling=True), DAY_CAP)),
        "stream_ad_count_by_province": _late_query(
            clicks, lambda s: windows.ad_count_by_province(_capped(s).where("kind = 'pass'")), number="l_orderkey", fast=1),
        "stream_login_fail_window": _query(
            tables.login, lambda s: processors.login_fail_window(s, "seq"), "3 seconds"),
        "stream_login_fail_consecutive": _query(
            tables.login, lambda s: processors.login_fail_consecutive(s, "seq"), "3 seconds"),
        "stream_order_pay_monitor": _query(orders, processors.order_pay_monitor),
        "stream_order_pay_pattern": _query(orders, processors.order_pay_pattern),
        "stream_reconcile": _reconcile,
        "stream_interval_join": _matched,
        "stream_daily_documents": _daily,
    }
