"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every batch query runs once to warm up and three times for the median.  Results go to
Spark's no-op sink, so all rows are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.operators import visits  # noqa: E402
from shoplens.plans import streams  # noqa: E402
from shoplens.plans.queries import queries  # noqa: E402
from shoplens.session import build_session  # noqa: E402
from shoplens.sources import tables  # noqa: E402

HEADLINE = [
    "hot_item_counts", "hot_items_top_n", "hot_items_sql", "hot_page_counts", "hot_pages_top_n", "late_page_views",
    "pv_tumbling", "uv_exact", "uv_bloom_running", "uv_hll", "marketing_by_channel",
    "ad_clicks_capped", "ad_count_by_province", "login_fail_window", "login_fail_consecutive",
    "order_pay_monitor", "order_pay_matched", "pay_receipt_matched", "unmatched_pays", "pay_receipt_interval_join",
]


# streams run once: most of their time is starting and committing micro-batches
STREAMS = ["stream_hot_items_top_n", "stream_hot_page_counts", "stream_order_pay_monitor"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1)))
    names = sys.argv[1:] or HEADLINE + STREAMS
    spark = build_session("shoplens-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="8g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = {**queries(), **streams.queries()}, {}
    # the registered query sets the estimates beside exact counts; timed is the sketch
    registered["uv_hll"] = lambda session, sf: visits.uv_hll(tables.user_behavior(session, sf))
    for name in names:
        runs = []
        for _ in range(1 if name.startswith("stream_") else 4):
            begin = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
