"""Hand-computed answers at the edges of every operator.  H is a full hour in seconds."""

import random

import pytest

from shoplens import schemas
from shoplens.functions import dates, filters, quality
from shoplens.functions.bitmap import bit_offset
from shoplens.operators import ads, hot, marketing, patterns, payments, visits
from shoplens.sources import decode

H = 1_700_000_000 // 86400 * 86400


def table(df):
    return sorted(tuple(r) for r in df.collect())


def views(spark, rows, behavior="pv"):
    """rows: (user, item, second after H)."""
    data = [(u, i, 0, behavior, H + t, n) for n, (u, i, t) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.USER_BEHAVIOR + ", event_id BIGINT")


def logins(spark, texts):
    """``["f0 f1 s4", ...]``: failures and successes, one user per text."""
    data = [(user, "ip", "fail" if w[0] == "f" else "success", H + int(w[1:]), n)
            for user, text in enumerate(texts) for n, w in enumerate(text.split())]
    return spark.createDataFrame(data, schemas.LOGIN + ", seq BIGINT")


def orders(spark, texts):
    """``["c0 p899", ...]``: creates and pays, one order per text."""
    data = [(order, "create" if w[0] == "c" else "pay", "" if w[0] == "c" else "tx", H + int(w[1:]))
            for order, text in enumerate(texts) for w in text.split()]
    return spark.createDataFrame(data, schemas.ORDER)


# --- windows -----------------------------------------------------------------------------------


def test_one_view_lies_in_twelve_windows(spark):
    got = table(hot.hot_item_counts(views(spark, [(1, 1, 0)])))
    assert got == [(1, (H + 300 * k) * 1000, 1) for k in range(1, 13)]


def test_sliding_counts_with_gaps_and_across_a_span(spark):
    times = [0, 1, 299, 300, 4000, 86_399, 86_400, 90_000, 200_000]
    got = dict(((w, c) for _, w, c in table(hot.hot_item_counts(views(spark, [(1, 5, t) for t in times])))))
    want = {}
    for t in times:
        for end in range(t // 300 * 300 + 300, t // 300 * 300 + 3601, 300):
            key = (H + end) * 1000
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_other_behaviour_and_null_are_not_counted(spark):
    rows = views(spark, [(1, 1, 0)], "buy").unionByName(views(spark, [(1, 1, 0)], None))
    assert hot.hot_item_counts(rows).count() == 0


def test_sliding_needs_a_dividing_slide(spark):
    with pytest.raises(ValueError):
        hot.hot_item_counts(views(spark, [(1, 1, 0)]), "1 hour", "7 minutes")


def test_top_n_orders_by_count_then_id(spark):
    counts = spark.createDataFrame([("a", 1, 3), ("b", 1, 3), ("c", 1, 5)], "item_id string, window_end bigint, count bigint")
    assert table(hot.top_n(counts, "item_id", 2)) == [(1, 1, "c", 5), (1, 2, "a", 3)]
    assert table(hot.top_n(counts, "item_id", 1, ascending=True)) == [(1, 1, "a", 3)]


def test_report_text(spark):
    counts = spark.createDataFrame([(9, H * 1000, 3), (4, H * 1000, 5)], "item_id bigint, window_end bigint, count bigint")
    (row,) = hot.top_n_report(hot.top_n(counts, "item_id"), "item_id").collect()
    assert row.report == "window end: 2023-11-14 00:00:00.0\nNo 1: 4, 5\nNo 2: 9, 3"


def test_static_and_post_requests_are_no_page_views(spark):
    log = spark.createDataFrame(
        [("i", "u", H, "GET", "/a.css"), ("i", "u", H, "GET", "/a.css/x"), ("i", "u", H, "POST", "/b"), ("i", "u", H, "GET", "/js")],
        schemas.ACCESS_LOG)
    assert table(hot.page_views(log).select("url")) == [("/a.css/x",), ("/js",)]
    assert hot.hot_page_counts(log).count() == 240


@pytest.mark.parametrize("bits", [0, 1, 20])
def test_late_rows_in_arrival_order(spark, bits):
    # newest window of second 0 ends at 600; with lateness it is gone once the watermark reaches 659.999
    arrivals = [0, 660, 0, 661, 0, 4, 700, 41, 39]
    late = [False, False, False, False, True, True, False, False, True]
    data = [("i", "u", H + t, "GET", f"/{n}", n) for n, t in enumerate(arrivals)]
    log = spark.createDataFrame(data, schemas.ACCESS_LOG + ", seq BIGINT")
    split = hot.split_late(log, "seq", bits=bits)
    assert table(split.late.select("seq")) == [(n,) for n, x in enumerate(late) if x]
    assert split.on_time.count() == late.count(False)


def test_page_views_and_visitors_per_hour(spark):
    rows = views(spark, [(1, 1, 0), (1, 1, 1), (2, 1, 3599), (3, 1, 3600)])
    first, second = (H + 3600) * 1000, (H + 7200) * 1000
    assert table(visits.pv_tumbling(rows)) == [("pv", first, 3), ("pv", second, 1)]
    assert table(visits.pv_salted(rows)) == table(visits.pv_tumbling(rows))
    assert table(visits.pv_salted(rows, salts=3)) == table(visits.pv_tumbling(rows))
    assert table(visits.uv_exact(rows)) == [("uv", first, 2), ("uv", second, 1)]


@pytest.mark.parametrize("bits", [0, 1, 20])
def test_running_counts(spark, bits):
    rows = views(spark, [(1, 1, 0), (1, 1, 1), (2, 1, 2), (3, 1, 3600), (1, 1, 3)])
    first, second = (H + 3600) * 1000, (H + 7200) * 1000
    assert table(visits.uv_bloom_running(rows, "event_id", range_bits=bits)) == [
        ("uv", first, 1), ("uv", first, 2), ("uv", second, 1)]
    assert table(visits.pv_per_record(rows, "event_id", range_bits=bits)) == [
        ("pv", first, 0, 1), ("pv", first, 1, 2), ("pv", first, 2, 3), ("pv", first, 4, 4), ("pv", second, 3, 1)]


def test_bit_offset_equals_the_whole_polynomial(spark):
    ids = [0, 7, 61, 199_999, -15, 9_223_372_036_854_775_807, -9_223_372_036_854_775_808]

    def polynomial(text):
        total = 0
        for letter in text:
            total = total * 61 + ord(letter)
        return total % 2**29

    got = spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", bit_offset("id").alias("bit")).collect()
    assert {r.id: r.bit for r in got} == {i: polynomial(str(i)) for i in ids}
    assert polynomial(str(2**63 - 1)) == 206_843_804


def test_sketches_cumulative_and_per_window(spark):
    rows = views(spark, [(1, 1, 0), (2, 1, 1), (2, 1, 3600), (3, 1, 3601)])
    assert [c for _, _, c in table(visits.uv_hll(rows))] == [2, 3]
    assert [c for _, _, c in table(visits.uv_hll(rows, per_window=True))] == [2, 2]


def test_sketch_error_is_small(spark):
    rows = views(spark, [(u, 1, u % 7200) for u in range(20_000)])
    exact, estimates = [10_800, 20_000], [c for _, _, c in table(visits.uv_hll(rows))]
    seen = [sum(1 for u in range(20_000) if u % 7200 < 3600), 20_000]
    assert all(abs(e - s) / s < 0.05 for e, s in zip(estimates, seen)), (estimates, exact)


def test_marketing_keeps_null_and_drops_uninstall(spark):
    data = [(1, "INSTALL", "c", H), (2, "UNINSTALL", "c", H), (3, None, "c", H)]
    events = spark.createDataFrame(data, schemas.MARKETING)
    total = marketing.marketing_total(events).collect()
    assert len(total) == 12 and {(r.channel, r.behavior, r["count"]) for r in total} == {("total", "total", 2)}
    assert min(r.window_end for r in total) == "2023-11-14 00:05:00.0"
    by = marketing.marketing_by_channel(events).collect()
    assert {(r.channel, r.behavior, r["count"]) for r in by} == {("c", "INSTALL", 1), ("c", None, 1)}


def test_click_cycle_starts_at_the_first_click(spark):
    """100 clicks before midnight and 100 after it are one cycle; 24 hours after the first click a new one starts."""
    day = 20_000 * 86_400
    at = [day - 600] * 100 + [day + 600] * 100 + [day + 85_799] + [day + 85_800] * 101
    rows = [(1, 1, "p", "c", t, n) for n, t in enumerate(at)] + [(None, 1, "p", "c", day, 900), (1, None, "p", "c", day, 901)]
    clicks = spark.createDataFrame(rows, "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, timestamp BIGINT, tie BIGINT")
    passed, warnings = ads.cap_clicks_from_first(clicks, ["tie"])
    assert sorted(r.tie for r in passed.collect()) == [*range(100), *range(201, 301), 900, 901]
    assert [tuple(r) for r in warnings.collect()] == [(1, 1, "click over 100times.")] * 2
    assert passed.columns == clicks.columns


def test_click_cap_and_warning(spark):
    data = [(1, 1, "p", "c", H + t, n) for n, t in enumerate([0, 1, 2, 3, 86_400])]
    clicks = spark.createDataFrame(data, schemas.AD_CLICK + ", tie BIGINT")
    passed, warnings = ads.cap_clicks(clicks, ["tie"], cap=2)
    assert table(passed.select("tie")) == [(0,), (1,), (4,)]
    assert table(warnings) == [(1, 1, "click over 2times.")]
    assert ads.ad_count_by_province(passed).count() == 24


# --- login patterns ----------------------------------------------------------------------------

WINDOWED = {  # 3 failures within 5 s: (first, last, times)
    "f0 f1 f5": [(0, 5, 3)],
    "f0 f1 f2 s4": [],
    "f0 f1 f2 s5": [],
    "f0 f1 f2 s6": [(0, 2, 3)],
    "f0 f1 f2 f6 f7 f8": [(0, 2, 3), (6, 8, 3)],
    "f0 f2 f4 f6 f8 f10 f12 f14 f16": [(0, 4, 3), (6, 10, 3), (12, 16, 3)],
    "f0 f0 f0 s0 f0 f0 f0": [(0, 0, 3)],
    "f0 f0 s0 f0 s0 f0 f0 f1": [(0, 1, 3)],
    "f0 f1 s1 f1 f1 f2": [(1, 2, 3)],
    "f0 f1 f2 s2 f2 s2": [],
    "s0 f1 f1": [],
}


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 600])
def test_login_window(spark, chunk):
    got = table(patterns.login_fail_window(logins(spark, WINDOWED), "seq", max_fail=3, chunk_s=chunk))
    assert got == [(user, H + a, H + b, f"login fail in 5s for {n} times")
                   for user, want in enumerate(WINDOWED.values()) for a, b, n in want]


CONSECUTIVE = {
    "f0 f1 f2 f3": [(0, 2), (1, 3)],
    "f0 f1 s2 f3": [],
    "f0 f1 f5": [],
    "f0 f1 f4": [(0, 4)],
    "f0 f0 f0 f0": [(0, 0), (0, 0)],
    "f0 f0 s0 f0": [],
}


@pytest.mark.parametrize("slice_s", [1, 4, 60])
def test_login_consecutive(spark, slice_s):
    got = table(patterns.login_fail_consecutive(logins(spark, CONSECUTIVE), "seq", slice_s=slice_s))
    assert got == [(user, H + a, H + b, "login fail 3 times")
                   for user, want in enumerate(CONSECUTIVE.values()) for a, b in want]


# --- order patterns ----------------------------------------------------------------------------

MONITORED = {
    "c0 p899": ["payed successfully"],
    "c0 p900": ["payed but already timeout"],
    "c0": ["timeout"],
    "p10": ["payed but not found created log"],
    "p10 c20": ["payed but not found created log", "timeout"],
    "c5 p5": ["payed successfully"],
}


REPEATED = {
    "c0 p10 c100 p110": ["payed successfully"] * 2,
    "c0 p901": ["payed but not found created log", "timeout"],
    "c0 c100 p950": ["payed successfully"],
    "c0 c900 p901": ["payed successfully"],
    "c0 c901 p1801": ["payed but already timeout", "timeout"],
    "p5 p5": ["payed but not found created log"],
    "p5 p6": ["payed but not found created log"] * 2,
    "c0 p0 p0 p0": ["payed but not found created log", "payed successfully"],
    "c0 p5 p5": ["payed but not found created log", "payed successfully"],
    "c0 p5 p6": ["payed but not found created log", "payed successfully"],
    "c0 c0": ["timeout"],
    "c3599 p3600 c7000 c7100 p8001": ["payed but not found created log", "payed successfully", "timeout"],
}


@pytest.mark.parametrize("slice_s", [50, 900, 3600])
def test_order_monitor_of_repeated_rows(spark, slice_s):
    got = table(patterns.order_pay_monitor(orders(spark, REPEATED), slice_s=slice_s))
    assert got == [(order, state, state != "payed successfully")
                   for order, want in enumerate(REPEATED.values()) for state in want]


def test_payments_are_used_once(spark):
    pays = [(1, "pay", "t", H), (2, "pay", "t", H), (3, "pay", "u", H), (4, "pay", "u", H + 1), (5, "pay", "v", H + 2)]
    receipts = [("t", "a", H + 1), ("t", "b", H + 1), ("u", "c", H + 2), ("v", "d", H), ("v", "e", H + 4)]
    sides = spark.createDataFrame(pays, schemas.ORDER), spark.createDataFrame(receipts, schemas.RECEIPT)
    got = payments.pay_receipt_match(*sides)
    assert table(got.matched.select("order_id", "pay_channel")) == [(2, "a"), (4, "c"), (5, "d")]
    assert table(got.unmatched_pays.select("order_id")) == [(1,), (3,)]
    assert table(got.unmatched_receipts.select("pay_channel")) == [("b",), ("e",)]
    assert payments.pay_receipt_interval_join(*sides).count() == 8


def test_order_monitor(spark):
    got = table(patterns.order_pay_monitor(orders(spark, MONITORED)))
    assert got == [(order, state, state != "payed successfully")
                   for order, want in enumerate(MONITORED.values()) for state in want]


PAIRED = {  # paid creates, then the ends of those timed out
    "c0 p299": (1, []),
    "c0 p300": (0, [300]),
    "c0 c10 p20": (2, []),
    "c0 c10 c10 p305": (2, [300]),
    "p0 c1": (0, [301]),
    "c3599 p3600": (1, []),
    "c0 p0": (1, []),
}


@pytest.mark.parametrize("slice_s", [7, 300, 3600])
def test_order_pattern(spark, slice_s):
    matched, timed_out = patterns.order_pay_pattern(orders(spark, PAIRED), slice_s=slice_s)
    assert table(matched) == [(o, "payId") for o, (paid, _) in enumerate(PAIRED.values()) for _ in range(paid)]
    assert table(timed_out) == [(o, f"timeout{(H + t) * 1000}") for o, (_, late) in enumerate(PAIRED.values()) for t in late]


def test_many_equal_creates_are_all_reported(spark):
    many = spark.range(25_001).selectExpr("7L AS order_id", "'create' AS event_type", "'' AS tx_id", f"{H}L AS timestamp")
    assert patterns.order_pay_pattern(many).timed_out.count() == 25_001


# --- payments ----------------------------------------------------------------------------------


def one_to_one(pays, receipts):
    """The rules of J1-J3, row after row."""
    pairs, left = set(), set()
    for tx in {p[2] for p in pays} | {r[0] for r in receipts}:
        rows = sorted([(p[3], False, p[0]) for p in pays if p[2] == tx] + [(r[2], True, r[1]) for r in receipts if r[0] == tx])
        waiting = None
        for row in [*rows, None]:
            if waiting and row and waiting[1] != row[1] and row[0] <= waiting[0] + (3 if waiting[1] else 5):
                pay, receipt = (waiting, row) if row[1] else (row, waiting)
                pairs.add((pay[2], receipt[2]))
                waiting = None
                continue
            if waiting:
                left.add(waiting[2])
            waiting = row
    return pairs, left


@pytest.mark.parametrize("slice_s", [10, 17, 600])
def test_chains_of_payments_across_slices(spark, slice_s):
    rng = random.Random(slice_s)
    pays = [(n, "pay", f"t{rng.randrange(4)}", H + rng.randrange(200)) for n in range(160)]
    receipts = [(f"t{rng.randrange(4)}", f"c{n}", H + rng.randrange(200)) for n in range(160)]
    got = payments.pay_receipt_match(
        spark.createDataFrame(pays, schemas.ORDER), spark.createDataFrame(receipts, schemas.RECEIPT), slice_s=slice_s)
    pairs, left = one_to_one(pays, receipts)
    assert {(r.order_id, r.pay_channel) for r in got.matched.collect()} == pairs
    alone = [r.order_id for r in got.unmatched_pays.collect()] + [r.pay_channel for r in got.unmatched_receipts.collect()]
    assert set(alone) == left and len(alone) == len(left)


def test_payments_take_few_exchanges(spark):
    pays = spark.createDataFrame([(1, "pay", "t", H)], schemas.ORDER)
    receipts = spark.createDataFrame([("t", "c", H)], schemas.RECEIPT)
    found = payments.pay_receipt_match(pays, receipts).unmatched_pays
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4


def test_payments_at_the_edges_of_the_interval(spark):
    pays = spark.createDataFrame(
        [(n, "pay", tx, H + 100) for n, tx in enumerate(["a", "b", "c", "d", "", None])], schemas.ORDER)
    receipts = spark.createDataFrame(
        [("a", "x", H + 97), ("b", "x", H + 105), ("c", "x", H + 96), ("d", "x", H + 106), ("", "x", H + 100), (None, "x", H)],
        schemas.RECEIPT)
    matched, pays_left, receipts_left = payments.pay_receipt_match(pays, receipts)
    assert table(matched.select("tx_id", "receipt_time")) == [("a", H + 97), ("b", H + 105)]
    assert sorted(r.order_id for r in pays_left.collect()) == [2, 3, 5]
    assert sorted(str(r.tx_id) for r in receipts_left.collect()) == ["", "None", "c", "d"]


def test_interval_join_is_many_to_many(spark):
    pays = spark.createDataFrame([(1, "pay", "a", H + 59), (2, "pay", "a", H + 61)], schemas.ORDER)
    receipts = spark.createDataFrame([("a", "x", H + 60), ("a", "y", H + 63)], schemas.RECEIPT)
    got = table(payments.pay_receipt_interval_join(pays, receipts).select("order_id", "pay_channel"))
    assert got == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]


# --- scalar functions, decoders ----------------------------------------------------------------


def test_null_passes_the_negated_filters(spark):
    rows = spark.createDataFrame([(None,), ("UNINSTALL",), ("",), ("x",)], "v string")
    assert table(rows.where(filters.is_installed("v")).fillna("null")) == [("",), ("null",), ("x",)]
    assert table(rows.where(filters.has_transaction("v")).fillna("null")) == [("UNINSTALL",), ("null",), ("x",)]


def test_dates_keep_the_milliseconds(spark):
    row = spark.createDataFrame([(1_623_841_990_204,)], "ms bigint").select(
        dates.start_of_day("ms"), dates.end_of_day("ms"), dates.floor_hour("ms"), dates.next_hour("ms"),
        dates.day_string("ms"), dates.window_end_string(dates.floor_hour("ms") - 204)).first()
    assert tuple(row) == (1_623_801_600_204, 1_623_887_999_204, 1_623_841_200_204, 1_623_844_800_204,
                          "2021-06-16", "2021-06-16 11:00:00.0")


def test_validation_codes(spark):
    schema = "o int, l array<int>, s string, n bigint"
    rows = [(None, [1], "a", 1), (1, None, "a", 1), (1, [], "a", 1), (1, [1], None, 1), (1, [1], "", 1),
            (1, [1], "a", 0), (1, [1], "a", None), (1, [1], "a", 5)]
    rules = [("o", "not_null"), ("l", "not_empty_list"), ("s", "not_empty_str"), ("n", "positive")]
    valid, rejected = quality.validate(spark.createDataFrame(rows, schema), rules)
    assert [r.n for r in valid.collect()] == [5]
    assert sorted(r.code for r in rejected.collect()) == [1001, 1001, 1002, 1002, 1003, 1003, 1004]
    with pytest.raises(ValueError):
        quality.rule_code("o", "odd")


GOOD = {
    "user_behavior": ("1,2,3,pv,9", (1, 2, 3, "pv", 9)),
    "access_log": ("10.0.0.1,u,-,17/05/2015:10:05:03,+0000,GET,/x", ("10.0.0.1", "u", 1_431_857_103, "GET", "/x")),
    "marketing": ("1,CLICK,wechat,9", (1, "CLICK", "wechat", 9)),
    "ad_click": ("1,2,p,c,9", (1, 2, "p", "c", 9)),
    "login": ("1,ip,fail,9", (1, "ip", "fail", 9)),
    "order": ("1,create,,9", (1, "create", "", 9)),
    "receipt": ("tx,wechat,9", ("tx", "wechat", 9)),
}


@pytest.mark.parametrize("kind", GOOD)
def test_decoders(spark, kind):
    line, fields = GOOD[kind]
    short = ",".join(line.split(",")[:-1])
    lines = spark.createDataFrame([(line,), (short,), ("x" + short + ",y",), ("",)], "value string")
    assert table(decode.decode(lines.limit(1), kind)) == [fields]
    good = decode.decode(lines, kind, "permissive")
    bad = decode.corrupt_lines(lines, kind)
    assert fields in table(good) and good.count() + bad.count() == 4
    assert (short,) in table(bad) and ("",) in table(bad)
    with pytest.raises(Exception, match="bad .* line"):
        decode.decode(lines, kind).count()
    with pytest.raises(ValueError):
        decode.decode(lines, kind, "other")


def test_seconds_of_rolling_cycles_are_made_distinct_once(spark, monkeypatch):
    plans, write = [], ads.written
    monkeypatch.setattr(ads, "written", lambda session, df, label: plans.append(
        (label, df._jdf.queryExecution().optimizedPlan().toString())) or write(session, df, label))
    clicks = spark.range(40).selectExpr("id % 3 AS user_id", "id % 2 AS ad_id", "id * 9000 AS timestamp", "id AS tie")
    passed, _ = ads.cap_clicks_from_first(clicks, ["tie"], cap=5)
    assert passed.count() > 0
    assert [label for label, plan in plans if "Range (" in plan] == ["seconds"]
