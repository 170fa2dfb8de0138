"""One key holds most of the rows; results are compared with a plain walk over the rows."""

import random

import pytest

from shoplens import schemas
from shoplens.operators import ads, hot, patterns, payments, visits

H = 1_700_000_000 // 86400 * 86400


def table(df):
    return sorted(tuple(r) for r in df.collect())


def skewed_logins(spark, seed, success):
    rng, data = random.Random(seed), []
    for n in range(3000):
        user = 1 if rng.random() < 0.7 else rng.randrange(2, 40)
        data.append((user, "ip", "success" if rng.random() < success else "fail", H + rng.randrange(900), n))
    return data, spark.createDataFrame(data, schemas.LOGIN + ", seq BIGINT").repartition(4)


def by_user(data):
    users = {}
    for user, _, state, at, seq in sorted(data, key=lambda r: (r[3], r[4])):
        users.setdefault(user, []).append((at, state == "fail"))
    return users


def walk_windows(data, max_fail, within):
    out = []
    for user, events in by_user(data).items():
        window = None
        for at, failed in events + [(10**12, True)]:
            if window and at > window[0] + within:
                if window[1] >= max_fail:
                    out.append((user, window[0], window[2], f"login fail in {within}s for {window[1]} times"))
                window = None
            if not failed:
                window = None
            elif window:
                window = (window[0], window[1] + 1, at)
            else:
                window = (at, 1, at)
    return sorted(out)


@pytest.mark.parametrize("success, chunk", [(0.0, 60), (0.02, 7), (0.3, 3)])
def test_login_windows_of_a_busy_user(spark, success, chunk):
    data, df = skewed_logins(spark, chunk, success)
    got = table(patterns.login_fail_window(df, "seq", max_fail=3, within_s=5, chunk_s=chunk))
    assert got == walk_windows(data, 3, 5) and got


@pytest.mark.parametrize("times, within", [(3, 5), (4, 2), (2, 1)])
def test_consecutive_failures_of_a_busy_user(spark, times, within):
    data, df = skewed_logins(spark, 5, 0.2)
    want = []
    for user, events in by_user(data).items():
        for i in range(times - 1, len(events)):
            run = events[i - times + 1:i + 1]
            if all(failed for _, failed in run) and run[-1][0] - run[0][0] < within:
                want.append((user, run[0][0], run[-1][0], f"login fail {times} times"))
    assert table(patterns.login_fail_consecutive(df, "seq", times, within, slice_s=13)) == sorted(want)


def test_order_pattern_of_a_busy_order(spark):
    rng, data = random.Random(3), []
    for _ in range(1500):
        order = 1 if rng.random() < 0.7 else rng.randrange(2, 30)
        data.append((order, rng.choice(["create", "create", "pay"]), "", H + rng.randrange(20_000)))
    paid, late = [], []
    for order, kind, _, at in data:
        if kind == "create":
            ok = any(o == order and k == "pay" and at <= t < at + 30 for o, k, _, t in data)
            (paid if ok else late).append((order, "payId" if ok else f"timeout{(at + 30) * 1000}"))
    matched, timed_out = patterns.order_pay_pattern(spark.createDataFrame(data, schemas.ORDER), 30, slice_s=100)
    assert table(matched) == sorted(paid) and table(timed_out) == sorted(late)


def test_busy_transaction(spark):
    rng = random.Random(4)
    tx = lambda: "hot" if rng.random() < 0.6 else rng.choice([f"t{n}" for n in range(50)] + [""])
    pays = [(n, "pay", tx(), H + rng.randrange(3000)) for n in range(600)]
    receipts = [(tx(), str(n), H + rng.randrange(3000)) for n in range(600)]
    pairs, waiting = set(), {}
    merged = [(p[3], 0, p[0], p[2]) for p in pays] + [(r[2], 1, r[1], r[0]) for r in receipts]
    for at, side, name, key in sorted(merged, key=lambda m: (m[0], m[1], m[2] if m[1] == 0 else 0, str(m[2]))):
        before = waiting.pop(key, None)
        if key and before and before[1] != side and at - before[0] <= (5 if side else 3):
            pairs.add((before[2], name) if side else (name, before[2]))
        else:
            waiting[key] = at, side, name
    got = payments.pay_receipt_match(
        spark.createDataFrame(pays, schemas.ORDER), spark.createDataFrame(receipts, schemas.RECEIPT))
    assert table(got.matched.select("order_id", "pay_channel")) == sorted(pairs)
    alone = {p[0] for p in pays if p[2]} - {p for p, _ in pairs}
    assert table(got.unmatched_pays.select("order_id")) == [(n,) for n in sorted(alone)]
    left = {r[1] for r in receipts} - {r for _, r in pairs}
    assert table(got.unmatched_receipts.select("pay_channel")) == [(n,) for n in sorted(left)]


def test_busy_item_and_hour(spark):
    rng, data = random.Random(6), []
    for n in range(4000):
        item = 1 if rng.random() < 0.7 else rng.randrange(2, 50)
        data.append((rng.randrange(300), item, 0, "pv", H + int(rng.triangular(0, 40_000, 3700)), n))
    df = spark.createDataFrame(data, schemas.USER_BEHAVIOR + ", event_id BIGINT").repartition(5)
    want = {}
    for _, item, _, _, at, _ in data:
        for end in range(at // 300 * 300 + 300, at // 300 * 300 + 3601, 300):
            want[item, end * 1000] = want.get((item, end * 1000), 0) + 1
    assert table(hot.hot_item_counts(df)) == sorted((i, e, c) for (i, e), c in want.items())
    firsts = {}
    for user, _, _, _, at, n in data:
        firsts.setdefault((at // 3600, user), n)
    hours = {}
    for (hour, _), n in sorted(firsts.items(), key=lambda x: x[1]):
        hours.setdefault(hour, []).append(n)
    running = sorted(("uv", (h + 1) * 3_600_000, k + 1) for h, ns in hours.items() for k in range(len(ns)))
    assert table(visits.uv_bloom_running(df, "event_id", range_bits=5)) == running


def test_busy_clicker(spark):
    rng = random.Random(8)
    data = [(1 if rng.random() < 0.7 else rng.randrange(2, 9), 1, "p", "c", H + rng.randrange(3 * 86_400), n)
            for n in range(3000)]
    pairs = {}
    for row in sorted(data, key=lambda r: (r[4], r[5])):
        pairs.setdefault((row[0], row[4] // 86_400), []).append(row)
    df = spark.createDataFrame(data, schemas.AD_CLICK + ", tie BIGINT").repartition(6)
    passed, warnings = ads.cap_clicks(df, ["tie"], cap=40)
    assert table(passed) == sorted(r for rows in pairs.values() for r in rows[:40])
    assert table(warnings) == sorted((u, 1, "click over 40times.") for (u, _), rows in pairs.items() if len(rows) > 40)
