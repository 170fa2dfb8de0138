"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import dates, filters, quality
from shoplens.operators import ads, hot, marketing, patterns, payments, visits
from shoplens.plans.scratch import scratch_dir
from shoplens.sinks.documents import document_rows
from shoplens.sources import decode, tables
from shoplens.sources.lines import lines, multi_lines, register, with_event_time

Query = Callable[[SparkSession, str], DataFrame]


# --- lines -----------------------------------------------------------------------------------


def _csv(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.concat_ws(",", *columns).alias("value"))


def _behavior_lines(spark, sf):
    return _csv(tables.user_behavior(spark, sf), "user_id", "item_id", "category_id", "behavior", "timestamp")


def _order_lines(spark, sf):
    return _csv(tables.order_event(spark, sf), "order_id", "event_type", "tx_id", "timestamp")


def _receipt_lines(spark, sf):
    return _csv(tables.receipt(spark, sf), "tx_id", "pay_channel", "timestamp")


def _log_lines(spark, sf):
    log = tables.access_log(spark, sf)
    when = F.date_format(F.timestamp_seconds("timestamp"), decode.ACCESS_TIME)
    return log.select(F.concat_ws(",", "ip", "user_id", F.lit("-"), when, F.lit("+0000"), "method", "url").alias("value"))


def _source_lines(spark, sf):
    folder = scratch_dir(spark, "lines")
    _behavior_lines(spark, sf).write.text(f"{folder}/userBehavior")
    return lines(spark, [f"{folder}/userBehavior", f"{folder}/unused"])


def _source_multi_lines(spark, sf):
    folder = scratch_dir(spark, "topics")
    _order_lines(spark, sf).write.text(f"{folder}/OrderEvent")
    _receipt_lines(spark, sf).write.text(f"{folder}/ReceiptEvent")
    named = multi_lines(spark, {name: f"{folder}/{name}" for name in ("OrderEvent", "ReceiptEvent")})
    tagged = [df.select(F.lit(name).alias("topic"), "value") for name, df in named.items()]
    return tagged[0].unionByName(tagged[1])


def _corrupt(spark, sf):
    rows = tables.marketing(spark, sf)
    broken = F.when(F.col("event_id") % 10 == 1, F.concat_ws(",", "user_id", "behavior", "channel")).when(
        F.col("event_id") % 10 == 2,
        F.concat_ws(",", F.concat(F.lit("x"), F.col("user_id").cast("string")), "behavior", "channel", "timestamp"))
    line = F.coalesce(broken, F.concat_ws(",", "user_id", "behavior", "channel", "timestamp"))
    return decode.corrupt_lines(rows.select(line.alias("value")), "marketing")


def _event_time(spark, sf):
    timed = with_event_time(tables.user_behavior(spark, sf))
    return timed.select("event_id", F.unix_millis("ts").alias("event_ms"))


def _registered_view(spark, sf):
    register(with_event_time(tables.user_behavior(spark, sf)), "agg")
    return spark.sql("SELECT behavior, count(*) AS n, unix_millis(min(ts)) AS first_ms FROM agg GROUP BY behavior")


# --- filters and keys ------------------------------------------------------------------------


def _filter_uninstall(spark, sf):
    rows = tables.marketing(spark, sf).withColumn(
        "behavior", F.when(F.col("event_id") % 7 != 0, F.col("behavior")))
    return rows.where(filters.is_installed())


def _filter_transaction(spark, sf):
    rows = tables.order_event(spark, sf).withColumn("tx_id", F.when(F.col("order_id") % 9 != 0, F.col("tx_id")))
    return rows.where(filters.has_transaction())


def _constant_key(spark, sf):
    views = tables.user_behavior(spark, sf).where(filters.is_page_view())
    return views.groupBy(filters.constant_key("pv", "key")).agg(F.count("*").alias("count"))


def _salted(spark, sf):
    views = tables.user_behavior(spark, sf).where(filters.is_page_view())
    parts = views.groupBy(filters.salt("user_id", "item_id", "timestamp").alias("s")).agg(F.count("*").alias("n"))
    return parts.agg(F.sum("n").alias("rows"), F.count("*").cast("int").alias("salts"),
                     F.min(F.col("s").between(0, 9).cast("bigint")).alias("in_range"))


# --- windows ---------------------------------------------------------------------------------


def _hot_items(spark, sf):
    return hot.hot_item_counts(tables.user_behavior(spark, sf))


def _hot_pages(spark, sf):
    return hot.hot_page_counts(tables.access_log(spark, sf))


def _hot_pages_in_time(spark, sf):
    return hot.hot_page_counts(tables.delayed_access_log(spark, sf), tie="arrival")


def _hot_items_sql(spark, sf):
    register(with_event_time(tables.user_behavior(spark, sf)), "data_table")
    return hot.hot_items_sql(spark, "data_table")


def _late(spark, sf):
    return hot.mark_late(tables.delayed_access_log(spark, sf), "arrival")


def _capped(spark, sf, **options):
    return ads.cap_clicks(tables.ad_click(spark, sf), tables.CLICK_TIE, **options)


def _capped_24h(spark, sf, cap=50):
    """The clicks of two days; most pairs reach the cap in two cycles."""
    return ads.cap_clicks_from_first(tables.ad_click_days(spark, sf), tables.CLICK_TIE, cap)


def _capped_24h_counts(spark, sf):
    """A cap of one, which the tables reach: clicks passed and warnings of each user and ad."""
    passed, warnings = _capped_24h(spark, sf, cap=1)
    rows = passed.select("user_id", "ad_id", F.lit(1).alias("p"), F.lit(0).alias("w")).unionByName(
        warnings.select("user_id", "ad_id", F.lit(0).alias("p"), F.lit(1).alias("w")))
    return rows.groupBy("user_id", "ad_id").agg(F.sum("p").alias("passed"), F.sum("w").alias("warned"))


def _capped_per_hour(spark, sf):
    passed, warnings = _capped(spark, sf, cap=3, cycle_s=3600)
    rows = passed.select("user_id", "ad_id", F.lit(1).alias("p"), F.lit(0).alias("w")).unionByName(
        warnings.select("user_id", "ad_id", F.lit(0).alias("p"), F.lit(1).alias("w")))
    return rows.groupBy("user_id", "ad_id").agg(F.sum("p").alias("passed"), F.sum("w").alias("warned"))


# --- joins, dates, validation, sinks ---------------------------------------------------------


def _reconciled(spark, sf):
    return payments.pay_receipt_match(tables.order_event(spark, sf), tables.receipt(spark, sf))


def _matched(spark, sf):
    return payments.pay_receipt_interval_join(tables.order_event(spark, sf), tables.receipt(spark, sf))


def _date_functions(spark, sf):
    events = tables.user_behavior(spark, sf)
    ms = events.select("event_id", (F.col("timestamp") * 1000 + F.col("event_id") % 1000).alias("ms"))
    whole = F.col("ms") - F.col("ms") % 1000
    return ms.select(
        "event_id", dates.start_of_day("ms").alias("start_of_day"), dates.end_of_day("ms").alias("end_of_day"),
        dates.floor_hour("ms").alias("floor_hour"), dates.next_hour("ms").alias("next_hour"),
        dates.day_string("ms").alias("day_string"), dates.window_end_string(whole).alias("window_end_string"))


def _validation(spark, sf):
    events = tables.load(spark, sf, "events")
    rows = events.select(
        F.when(F.col("user_id") % 11 != 0, F.col("user_id")).alias("user"),
        "value",
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("kind"),
        F.when(F.col("event_id") % 13 != 0, F.array("event_type")).otherwise(F.array().cast("array<string>")).alias("tags"))
    rows = rows.withColumn("value", F.col("value") - 20)
    rules = [("user", "not_null"), ("value", "positive"), ("kind", "not_empty_str"), ("tags", "not_empty_list")]
    valid, rejected = quality.validate(rows, rules)
    codes = rejected.select("code").unionByName(valid.select(F.lit(0).alias("code")))
    return codes.groupBy("code").agg(F.count("*").alias("n"))


def queries() -> dict[str, Query]:
    ub, log, mk, clicks = tables.user_behavior, tables.access_log, tables.marketing, tables.ad_click
    login, orders = tables.login, tables.order_event
    return {
        "source_lines": _source_lines,
        "source_multi_lines": _source_multi_lines,
        "decode_user_behavior": lambda s, d: decode.decode_user_behavior(_behavior_lines(s, d)),
        "decode_access_log": lambda s, d: decode.decode_access_log(_log_lines(s, d)),
        "decode_marketing": lambda s, d: decode.decode_marketing(
            _csv(mk(s, d), "user_id", "behavior", "channel", "timestamp")),
        "decode_ad_click": lambda s, d: decode.decode_ad_click(
            _csv(clicks(s, d), "user_id", "ad_id", "province", "city", "timestamp")),
        "decode_login": lambda s, d: decode.decode_login(
            _csv(login(s, d), "user_id", "ip", "login_state", "timestamp")),
        "decode_order": lambda s, d: decode.decode_order(_order_lines(s, d)),
        "decode_receipt": lambda s, d: decode.decode_receipt(_receipt_lines(s, d)),
        "decode_corrupt_lines": _corrupt,
        "event_time": _event_time,
        "registered_view": _registered_view,
        "filter_page_view": lambda s, d: ub(s, d).where(filters.is_page_view()),
        "filter_get": lambda s, d: log(s, d).where(filters.is_get()),
        "filter_static": lambda s, d: log(s, d).where(filters.is_page()),
        "filter_uninstall": _filter_uninstall,
        "filter_transaction": _filter_transaction,
        "constant_key": _constant_key,
        "salted_counts": _salted,
        "hot_item_counts": _hot_items,
        "hot_items_top_n": lambda s, d: hot.top_n(_hot_items(s, d), "item_id"),
        "hot_items_coldest": lambda s, d: hot.top_n(_hot_items(s, d), "item_id", ascending=True),
        "hot_items_sql": _hot_items_sql,
        "hot_items_report": lambda s, d: hot.top_n_report(hot.top_n(_hot_items(s, d), "item_id"), "item_id"),
        "hot_page_counts": _hot_pages,
        "hot_page_counts_in_time": _hot_pages_in_time,
        "hot_pages_top_n_in_time": lambda s, d: hot.top_n(_hot_pages_in_time(s, d), "url"),
        "hot_pages_top_n": lambda s, d: hot.top_n(_hot_pages(s, d), "url"),
        "late_page_views": _late,
        "pv_tumbling": lambda s, d: visits.pv_tumbling(ub(s, d)),
        "pv_salted": lambda s, d: visits.pv_salted(ub(s, d)),
        "uv_exact": lambda s, d: visits.uv_exact(ub(s, d)),
        "uv_bloom_running": lambda s, d: visits.uv_bloom_running(ub(s, d), "event_id"),
        "pv_per_record": lambda s, d: visits.pv_per_record(ub(s, d), "event_id"),
        "uv_hll": lambda s, d: visits.within(visits.uv_hll(ub(s, d)), visits.uv_so_far(ub(s, d))),
        "uv_hll_per_window": lambda s, d: visits.within(
            visits.uv_hll(ub(s, d), per_window=True), visits.uv_exact(ub(s, d))),
        "marketing_total": lambda s, d: marketing.marketing_total(mk(s, d)),
        "marketing_by_channel": lambda s, d: marketing.marketing_by_channel(mk(s, d)),
        "ad_clicks_capped": lambda s, d: _capped(s, d).passed,
        "ad_blacklist": lambda s, d: _capped(s, d).warnings,
        "ad_clicks_capped_per_hour": _capped_per_hour,
        "ad_clicks_capped_24h": lambda s, d: _capped_24h(s, d).passed,
        "ad_blacklist_24h": lambda s, d: _capped_24h(s, d).warnings,
        "ad_clicks_capped_24h_counts": _capped_24h_counts,
        "ad_count_by_province": lambda s, d: ads.ad_count_by_province(_capped(s, d).passed),
        "login_fail_window": lambda s, d: patterns.login_fail_window(login(s, d), "seq"),
        "login_fail_consecutive": lambda s, d: patterns.login_fail_consecutive(login(s, d), "seq"),
        "order_pay_monitor": lambda s, d: patterns.order_pay_monitor(orders(s, d)),
        "order_pay_matched": lambda s, d: patterns.order_pay_pattern(orders(s, d)).matched,
        "order_pay_timed_out": lambda s, d: patterns.order_pay_pattern(orders(s, d)).timed_out,
        "pay_receipt_matched": lambda s, d: _reconciled(s, d).matched,
        "unmatched_pays": lambda s, d: _reconciled(s, d).unmatched_pays,
        "unmatched_receipts": lambda s, d: _reconciled(s, d).unmatched_receipts,
        "pay_receipt_interval_join": _matched,
        "date_functions": _date_functions,
        "validation_codes": _validation,
        "daily_documents": lambda s, d: document_rows(_matched(s, d)),
    }
