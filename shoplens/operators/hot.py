"""Hot items and hot pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.functions.dates import window_end_string
from shoplens.functions.filters import is_get, is_page, is_page_view
from shoplens.operators.ordered import RANGE_BITS, max_before
from shoplens.operators.windows import floor_to, sliding_count, sliding_from_panes, to_seconds


def hot_item_counts(behavior: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """A1: page views per item and sliding window -> item_id, window_end, count."""
    return sliding_count(behavior.where(is_page_view()), ["item_id"], size, slide)


def top_n(counts: DataFrame, id_col: str, n: int = 5, ascending: bool = False) -> DataFrame:
    """The ``n`` largest (or smallest) counts of each window, ties by id.

    Spark trims every task to ``n`` rows per window before the exchange.
    """
    count = F.col("count").asc() if ascending else F.col("count").desc()
    rank = F.row_number().over(Window.partitionBy("window_end").orderBy(count, F.col(id_col)))
    return (
        counts.withColumn("rank", rank)
        .where(F.col("rank") <= n)
        .select("window_end", F.col("rank").cast("int").alias("rank"), id_col, "count")
    )


def hot_items_sql(spark: SparkSession, view: str, n: int = 5) -> DataFrame:
    """A3: the SQL form, on a view with item_id, behavior and a ``ts`` event time."""
    return spark.sql(f"""
        SELECT item_id, window_end, cnt, row_num
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INT) AS row_num
              FROM (SELECT item_id, unix_millis(pane.window.end) AS window_end, sum(pane_cnt) AS cnt
                    FROM (SELECT item_id, window(pane_start, '1 hour', '5 minutes') AS window, pane_cnt
                          FROM (SELECT item_id, window(ts, '5 minutes').start AS pane_start, count(item_id) AS pane_cnt
                                FROM {view} WHERE behavior = 'pv'
                                GROUP BY item_id, window(ts, '5 minutes'))) AS pane
                    GROUP BY item_id, pane.window))
        WHERE row_num <= {int(n)}""")


def top_n_report(ranked: DataFrame, id_col: str) -> DataFrame:
    """A4: one text per window; ``ranked`` holds at most N rows of a window."""
    line = F.concat(F.lit("No "), F.col("rank").cast("string"), F.lit(": "),
                    F.col(id_col).cast("string"), F.lit(", "), F.col("count").cast("string"))
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda entry: entry["line"]), "\n")
    grouped = ranked.groupBy("window_end").agg(body.alias("_body"))
    head = F.concat(F.lit("window end: "), window_end_string("window_end"), F.lit("\n"))
    return grouped.select("window_end", F.concat(head, "_body").alias("report"))


def page_views(log: DataFrame) -> DataFrame:
    """GET requests for pages, static resources left out."""
    return log.where(is_get() & is_page())


def hot_page_counts(log: DataFrame, size: str = "10 minutes", slide: str = "5 seconds", tie: str | None = None,
                    delay: str = "1 second", lateness: str = "1 minute", bits: int = RANGE_BITS) -> DataFrame:
    """A5: views per url and sliding window -> url, window_end, count.

    Without ``tie`` the counts hold every view.  With it, a unique arrival order, a view
    counts only in windows that the watermark before it had not yet passed by the allowed
    lateness, as if it had come on a stream.
    """
    if tie is None:
        return sliding_count(page_views(log), ["url"], size, slide)
    slide_s = to_seconds(slide)
    watermark = (F.col("_seen") - to_seconds(delay)) * 1000
    # windows whose last millisecond, end * 1000 - 1, lies beyond the watermark less the lateness
    open_after = F.floor((watermark - to_seconds(lateness) * 1000 + 1) / 1000)
    first = F.coalesce(floor_to(open_after, slide_s) + slide_s, F.lit(-1 << 40))
    seen = page_views(max_before(log, "timestamp", tie, "_seen", bits))
    # views on time share one value, so they stay one row per pane
    pane = floor_to("timestamp", slide_s)
    panes = seen.groupBy("url", pane.alias("_pane"), F.greatest(first, pane + slide_s).alias("_first")).agg(
        F.count("*").alias("_n"))
    return sliding_from_panes(panes, ["url"], size, slide, "_first")


class LateSplit(NamedTuple):
    on_time: DataFrame
    late: DataFrame


def mark_late(log: DataFrame, tie: str, delay: str = "1 second", lateness: str = "1 minute",
              slide: str = "5 seconds", size: str = "10 minutes", bits: int = RANGE_BITS) -> DataFrame:
    """Page views with ``late``, true where no window takes them any more.

    ``tie`` is the arrival order.  A row is late when the watermark before it had
    passed the end of its newest window by the allowed lateness.
    """
    slide_s = to_seconds(slide)
    newest_start = floor_to("timestamp", slide_s)
    last_milli = (newest_start + to_seconds(size)) * 1000 - 1
    seen = max_before(log, "timestamp", tie, "_seen", bits)
    watermark = (F.col("_seen") - to_seconds(delay)) * 1000
    late = F.coalesce(last_milli + to_seconds(lateness) * 1000 <= watermark, F.lit(False))
    return page_views(seen).withColumn("late", late).drop("_seen")


def split_late(log: DataFrame, tie: str, **options) -> LateSplit:
    """Page views in time for at least one window, and those late for all; options of :func:`mark_late`."""
    marked = mark_late(log, tie, **options)
    return LateSplit(marked.where("NOT late").drop("late"), marked.where("late").drop("late"))
