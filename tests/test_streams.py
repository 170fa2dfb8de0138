"""Streams against the batch forms, over several micro-batches, with restarts and late rows."""

import os
import random

import pytest

from shoplens import schemas
from shoplens.operators import ads, hot, marketing, patterns, payments, visits
from shoplens.sinks import streams as sinks
from shoplens.sinks.documents import document_rows
from shoplens.sources import decode
from shoplens.sources.lines import kafka_options, lines, multi_lines, register, with_event_time
from shoplens.streaming import joins, processors, windows
from shoplens.streaming.panes import SlidingCounts, retractions, sliding_counts
from tests.test_micro import CONSECUTIVE, MONITORED, PAIRED, REPEATED, WINDOWED, H, table

CLOSE = H + 30 * 86_400  # a last row this late closes everything before it
CLOSE_MS = CLOSE * 1000 - 86_400_000


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def feed(spark, folder, batches, schema):
    """One file and one micro-batch per list of rows, in this order."""
    folder = str(folder)
    os.makedirs(folder)
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, schema).coalesce(1).toPandas()
        path = f"{folder}/{n:03}.parquet"
        frame.to_parquet(path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(spark, stream, folder, sink=sinks.append_sink, keep=False, **options):
    sink(stream, f"{folder}/out", checkpoint=f"{folder}/checkpoint", drain=True, **options).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out if keep else out.drop("batch_id")


def thirds(rows, at):
    rows = sorted(rows, key=lambda r: r[at])
    cut = [len(rows) // 3, 2 * len(rows) // 3]
    return [rows[:cut[0]], rows[cut[0]:cut[1]], rows[cut[1]:]]


@pytest.fixture(scope="module")
def behavior_batches():
    rows = [(n % 17, n % 5, 0, "pv" if n % 3 else "buy", H + n * 37, n) for n in range(600)]
    return thirds(rows, 4) + [[(99, 99, 0, "pv", CLOSE, 10_000)]]


BEHAVIOR = schemas.USER_BEHAVIOR + ", event_id BIGINT"


def closed(df):
    return df.where(f"window_end < {CLOSE_MS}")


@pytest.mark.parametrize("name", ["hot_item_counts", "pv_tumbling", "pv_salted", "uv_exact"])
def test_closed_windows_equal_batch(spark, tmp_path, behavior_batches, name):
    batch = spark.createDataFrame([r for b in behavior_batches for r in b], BEHAVIOR)
    want = getattr(hot if name.startswith("hot") else visits, name)(batch)
    stream = with_event_time(feed(spark, tmp_path / "in", behavior_batches, BEHAVIOR))
    got = drain(spark, getattr(windows, name)(stream), tmp_path)
    assert table(closed(got)) == table(closed(want)) != []


def test_top_n_of_closed_windows(spark, tmp_path, behavior_batches):
    batch = spark.createDataFrame([r for b in behavior_batches for r in b], BEHAVIOR)
    stream = with_event_time(feed(spark, tmp_path / "in", behavior_batches, BEHAVIOR))
    got = drain(spark, windows.hot_item_counts(stream), tmp_path,
                lambda df, path, **o: sinks.top_n_sink(df, "item_id", path, n=2, **o))
    assert table(closed(got)) == table(closed(hot.top_n(hot.hot_item_counts(batch), "item_id", 2)))


def test_windows_close_by_the_time_of_all_rows(spark, tmp_path):
    batches = [[(1, 1, 0, "pv", H, 0)], [(1, 1, 0, "buy", CLOSE, 1)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, BEHAVIOR))
    assert table(drain(spark, windows.pv_tumbling(stream), tmp_path)) == [("pv", (H + 3600) * 1000, 1)]


def test_running_visitors_over_batches(spark, tmp_path, behavior_batches):
    batch = spark.createDataFrame([r for b in behavior_batches for r in b], BEHAVIOR)
    stream = with_event_time(feed(spark, tmp_path / "in", behavior_batches, BEHAVIOR))
    got = drain(spark, windows.uv_running(stream), tmp_path)
    assert table(got) == table(visits.uv_bloom_running(batch, "event_id"))


def test_a_count_for_every_record(spark, tmp_path, behavior_batches):
    batch = spark.createDataFrame([r for b in behavior_batches for r in b], BEHAVIOR)
    stream = with_event_time(feed(spark, tmp_path / "in", behavior_batches, BEHAVIOR))
    got = drain(spark, windows.pv_per_record(stream), tmp_path)
    assert table(got) == table(visits.pv_per_record(batch, "event_id").drop("event_id"))


def test_running_counts_end_with_their_window(spark, tmp_path):
    view = lambda user, t, n: (user, 1, 0, "pv", H + t, n)
    batches = [[view(1, 0, 0), view(2, 3599, 1), view(1, 5, 2)], [view(3, 3700, 3), view(2, 10, 4), view(4, 11, 5)],
               [view(5, 12, 6), view(3, 3701, 7)]]  # the hour is over: user 5 is late
    end = lambda hours: (H + 3600 * hours) * 1000
    for k, (operator, label, want) in enumerate([
            (windows.uv_running, "uv", [(end(1), 1), (end(1), 2), (end(1), 3), (end(2), 1)]),
            (windows.pv_per_record, "pv", [(end(1), n) for n in range(1, 6)] + [(end(2), 1), (end(2), 2)])]):
        stream = with_event_time(feed(spark, tmp_path / f"in{k}", batches, BEHAVIOR))
        assert table(drain(spark, operator(stream), tmp_path / f"run{k}")) == [(label, *row) for row in want]


def test_sketches_are_replaced_by_window(spark, tmp_path, behavior_batches):
    batch = spark.createDataFrame([r for b in behavior_batches for r in b], BEHAVIOR)
    stream = with_event_time(feed(spark, tmp_path / "in", behavior_batches, BEHAVIOR))
    versions = drain(spark, windows.uv_sketches(stream), tmp_path, sinks.upsert_sink, keep=True)
    newest = sinks.latest(versions, ["window_end"])
    assert table(sinks.uv_from_sketches(newest)) == table(visits.uv_hll(batch))
    assert table(sinks.uv_from_sketches(newest, per_window=True)) == table(visits.uv_hll(batch, per_window=True))


def test_marketing_windows(spark, tmp_path):
    rows = [(n, ["CLICK", "UNINSTALL", None][n % 3], "app", H + n * 50) for n in range(200)]
    batches = thirds(rows, 3) + [[(1, "CLICK", "app", CLOSE)]]
    batch = spark.createDataFrame([r for b in batches for r in b], schemas.MARKETING)
    for k, name in enumerate(["marketing_total", "marketing_by_channel"]):
        stream = with_event_time(feed(spark, tmp_path / f"in{k}", batches, schemas.MARKETING))
        got = drain(spark, getattr(windows, name)(stream), tmp_path / f"run{k}")
        want = getattr(marketing, name)(batch)
        early = "window_end < '2023-11-20'"
        assert table(got.where(early).fillna("null")) == table(want.where(early).fillna("null")) != []


# --- lateness, corrections ---------------------------------------------------------------------

LOG = schemas.ACCESS_LOG + ", seq BIGINT"


def test_late_split_uses_the_batches_before(spark, tmp_path):
    get = lambda t, n: ("i", "u", H + t, "GET", "/a", n)
    batches = [[get(0, 0), get(661, 1), get(0, 2)], [get(0, 3), get(4, 4), get(5, 5), get(700, 6)],
               [get(39, 7), get(40, 8), ("i", "u", H, "POST", "/a", 9)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, LOG), "1 second")
    query = sinks.late_split_sink(windows.marked_views(stream), f"{tmp_path}/ok", f"{tmp_path}/late",
                                  f"{tmp_path}/checkpoint", drain=True)
    query.awaitTermination()
    assert table(spark.read.parquet(f"{tmp_path}/late").select("seq")) == [(3,), (4,), (7,)]
    assert table(spark.read.parquet(f"{tmp_path}/ok").select("seq")) == [(0,), (1,), (2,), (5,), (6,), (8,)]


def test_corrected_counts_replace_and_retract(spark, tmp_path):
    get = lambda t, url="/a": ("i", "u", H + t, "GET", url, t)
    # the second batch closes what ends by 640; the third corrects what ends after 580
    batches = [[get(0), get(30)], [get(641, "/b")], [get(1), get(200, "/c")], [get(2000, "/b")]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, LOG), "1 second")
    versions = windows.hot_page_versions(stream)
    got = drain(spark, versions, tmp_path, keep=True)
    newest = got.groupBy("url", "window_end").agg({"count": "max"})
    late = lambda t, url: [r for r in table(hot.hot_page_counts(spark.createDataFrame([get(t, url)], LOG))) if r[1] > (H + 580) * 1000]
    want = {r[:2]: r[2] for r in table(hot.hot_page_counts(spark.createDataFrame([get(0), get(30)], LOG)))}
    for url, end, n in [*late(1, "/a"), *late(200, "/c")]:
        want[url, end] = want.get((url, end), 0) + n
    open_ = (H + 1999) * 1000
    on_time = {(r[0], r[1]): r[2] for r in table(newest) if r[0] != "/b"}
    assert on_time == {key: n for key, n in want.items() if key[1] <= open_}
    story = retractions(got, ["url"]).where(f"url = '/a' AND window_end = {(H + 600) * 1000}")
    assert sorted((r.added, r["count"]) for r in story.collect()) == [(False, 2), (True, 2), (True, 3)]
    untouched = got.where(f"url = '/a' AND window_end = {(H + 580) * 1000}")
    assert [(r["count"], r.before) for r in untouched.collect()] == [(2, None)]


def simulated(batches, size, slide, lateness, delay_ms):
    """Versions of windows by the rules, one row and one window at a time: (key, end, count, before)."""
    counts, given, out, seen = {}, {}, [], None

    def close(mark):
        for (key, end), n in sorted(counts.items()):
            if (key, end) not in given and end * 1000 - 1 <= mark:
                given[key, end] = n
                out.append((key, end * 1000, n, None))

    for rows in batches:
        mark = 0 if seen is None else seen * 1000 - delay_ms
        changed = set()
        for key, at in rows:
            for end in range(at // slide * slide + slide, at // slide * slide + size + 1, slide):
                if (end + lateness) * 1000 - 1 > mark:
                    counts[key, end] = counts.get((key, end), 0) + 1
                    if end * 1000 - 1 <= mark:
                        changed.add((key, end))
        for key, end in changed:
            out.append((key, end * 1000, counts[key, end], given.get((key, end))))
            given[key, end] = counts[key, end]
        seen = max([*(at for _, at in rows), *([] if seen is None else [seen])])
        close(seen * 1000 - delay_ms)
    return sorted(out, key=str)


@pytest.mark.parametrize("lateness", [0, 40, 200])
def test_late_rows_count_in_every_open_window(spark, tmp_path, lateness):
    rng, batches = random.Random(lateness), []
    for n in range(6):
        rows = [(rng.randrange(3), H + n * 300 + rng.randrange(300)) for _ in range(15)]
        rows += [(rng.randrange(4), H + n * 300 - rng.randrange(1, 500)) for _ in range(10)]  # late by up to all windows
        batches.append(rows)
    stream = with_event_time(feed(spark, tmp_path / "in", batches, "item BIGINT, timestamp BIGINT"), "5 seconds")
    versions = sliding_counts(stream, ["item"], "120 seconds", "20 seconds", f"{lateness} seconds", every_version=True)
    got = drain(spark, versions, tmp_path)
    want = simulated(batches, 120, 20, lateness, 5000)
    assert sorted([tuple(r) for r in got.select("item", "window_end", "count", "before").collect()], key=str) == want
    assert lateness == 0 or any(r[3] for r in want)


def test_ranks_change_with_late_rows(spark, tmp_path):
    view = lambda item, t: (0, item, 0, "pv", H + t, t)
    batches = [[view(1, 10), view(1, 20), view(2, 30)], [view(9, 4000)], [view(9, 4001)],
               [view(2, 50), view(2, 60), view(3, 70)], [view(9, 90_000)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, BEHAVIOR))
    got = drain(spark, windows.hot_item_ranks(stream, n=2, lateness="10 minutes"), tmp_path)
    end = (H + 3600) * 1000  # closed in the third batch, corrected by the fourth
    story = [(r.added, r.row_num, r.item_id, r.cnt) for r in got.where(f"window_end = {end}").collect()]
    assert sorted(story) == sorted([(True, 1, 1, 2), (True, 2, 2, 1), (False, 1, 1, 2), (True, 1, 2, 3),
                                    (False, 2, 2, 1), (True, 2, 1, 2)])
    final = [(r.added, r.row_num, r.item_id, r.cnt) for r in got.where(f"window_end = {(H + 300) * 1000}").collect()]
    assert sorted(final) == [(True, 1, 1, 2), (True, 2, 2, 1)]  # too long ago to be corrected


def test_corrections_take_one_pass_over_the_panes(monkeypatch):
    """As many spans are read for the windows that a late row reaches as there are, not once more for each of them."""
    counts = SlidingCounts(600, 5, 60, None)
    rng = random.Random(4)
    panes, new = ({5 * rng.randrange(2000): rng.randrange(1, 9) for _ in range(n)} for n in (900, 700))
    gone, closed = 4000, 9000
    at = lambda held, end: sum(n for pane, n in held.items() if end - 600 <= pane < end)
    want = [(end, at(panes, end) + at(new, end), at(panes, end) or None)
            for end in range(gone + 5, closed + 1, 5) if at(new, end)]
    passes = []
    monkeypatch.setattr(SlidingCounts, "_spans", lambda *args, old=SlidingCounts._spans: passes.append(1) or old(*args))
    spans = list(counts._corrected(panes, new, gone, closed))
    got = [(end, count, before) for first, last, count, before in spans for end in range(first, last + 1, 5)]
    assert got == want != [] and len(passes) <= 2


# --- state machines ----------------------------------------------------------------------------


def login_batches(texts):
    rows = [(user, "ip", "fail" if w[0] == "f" else "success", H + int(w[1:]), n)
            for user, text in enumerate(texts) for n, w in enumerate(text.split())]
    return thirds(rows, 3) + [[(999, "ip", "success", CLOSE, 0)]]


LOGIN = schemas.LOGIN + ", seq BIGINT"


def test_login_windows(spark, tmp_path):
    stream = with_event_time(feed(spark, tmp_path / "in", login_batches(WINDOWED), LOGIN), "30 seconds")
    got = drain(spark, processors.login_fail_window(stream, "seq", max_fail=3), tmp_path)
    assert table(got) == [(user, H + a, H + b, f"login fail in 5s for {n} times")
                          for user, want in enumerate(WINDOWED.values()) for a, b, n in want]


def test_login_pattern(spark, tmp_path):
    stream = with_event_time(feed(spark, tmp_path / "in", login_batches(CONSECUTIVE), LOGIN), "3 seconds")
    got = drain(spark, processors.login_fail_consecutive(stream, "seq"), tmp_path)
    assert table(got) == [(user, H + a, H + b, "login fail 3 times")
                          for user, want in enumerate(CONSECUTIVE.values()) for a, b in want]


def order_batches(texts):
    rows = [(order, "create" if w[0] == "c" else "pay", "", H + int(w[1:]))
            for order, text in enumerate(texts) for w in text.split()]
    return thirds(rows, 3) + [[(999, "create", "", CLOSE)]]


def test_order_monitor(spark, tmp_path):
    stream = with_event_time(feed(spark, tmp_path / "in", order_batches(MONITORED), schemas.ORDER), "2 seconds")
    got = drain(spark, processors.order_pay_monitor(stream), tmp_path)
    assert table(got) == [(order, state, state != "payed successfully")
                          for order, want in enumerate(MONITORED.values()) for state in want]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("monitor", ["orders", "logins"])
def test_any_split_gives_the_batch_result(spark, tmp_path, seed, monitor):
    """Rows shuffled within the watermark delay, cut into micro-batches at random."""
    rng = random.Random(seed)
    if monitor == "orders":
        rows = [(n % 4, rng.choice(["create", "pay"]), "", H + rng.randrange(8000)) for n in range(160)]
        schema, at, last = schemas.ORDER, 3, (999, "create", "", CLOSE)
    else:
        rows = [(n % 4, "ip", rng.choice(["fail", "fail", "fail", "success"]), H + rng.randrange(90), n) for n in range(160)]
        schema, at, last = LOGIN, 3, (999, "ip", "success", CLOSE, 0)
    rows.sort(key=lambda r: r[at] + rng.random() * 30)
    cuts = sorted(rng.sample(range(1, len(rows)), rng.choice([0, 2, 4])))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])] + [[last]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, schema), "31 seconds")
    batch = spark.createDataFrame(rows, schema)
    if monitor == "orders":
        got, want = processors.order_pay_monitor(stream), patterns.order_pay_monitor(batch)
    else:
        got, want = processors.login_fail_window(stream, "seq", 3), patterns.login_fail_window(batch, "seq", 3)
    assert table(drain(spark, got, tmp_path).where(f"{got.columns[0]} < 999")) == table(want) != []


def test_order_monitor_of_repeated_rows(spark, tmp_path):
    stream = with_event_time(feed(spark, tmp_path / "in", order_batches(REPEATED), schemas.ORDER), "2 seconds")
    got = drain(spark, processors.order_pay_monitor(stream), tmp_path)
    assert table(got) == [(order, state, state != "payed successfully")
                          for order, want in enumerate(REPEATED.values()) for state in want]


def test_order_monitor_after_the_deadline(spark, tmp_path):
    """A pay the timer did not wait for: the create has timed out, the pay finds nothing."""
    batches = [[(1, "create", "", H), (1, "pay", "", H + 901)], [(2, "create", "", CLOSE)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, schemas.ORDER))
    got = table(drain(spark, processors.order_pay_monitor(stream), tmp_path))
    assert got == [(1, "payed but not found created log", True), (1, "timeout", True)]


def test_order_pattern(spark, tmp_path):
    stream = with_event_time(feed(spark, tmp_path / "in", order_batches(PAIRED), schemas.ORDER), "2 seconds")
    got = drain(spark, processors.order_pay_pattern(stream), tmp_path)
    want = []
    for order, (paid, late) in enumerate(PAIRED.values()):
        want += [(order, "payId", False)] * paid + [(order, f"timeout{(H + t) * 1000}", True) for t in late]
    assert table(got) == sorted(want)


def state_rows(stream, folder):
    """The most rows that the state of a drained stream held."""
    query = sinks.append_sink(stream, f"{folder}/out", f"{folder}/checkpoint", drain=True)
    query.awaitTermination()
    return max(state["numRowsTotal"] for progress in query.recentProgress for state in progress["stateOperators"])


@pytest.mark.parametrize("monitor", ["orders", "logins"])
def test_state_of_machines_is_kept_by_bucket(spark, tmp_path, monkeypatch, monitor):
    """A value and a timer or two for each bucket, however many orders or users wait."""
    monkeypatch.setattr(processors, "BUCKETS", 8, raising=False)
    if monitor == "orders":
        rows = [(n, "create", "", H + n % 50) for n in range(400)]
        stream = with_event_time(feed(spark, tmp_path / "in", [rows, [(9999, "create", "", H + 200)]], schemas.ORDER))
        machine = processors.order_pay_monitor(stream)
    else:
        rows = [(n, "ip", "fail", H + n % 3, n) for n in range(400)]
        stream = with_event_time(feed(spark, tmp_path / "in", [rows, [(9999, "ip", "fail", H + 5, 0)]], LOGIN))
        machine = processors.login_fail_window(stream, "seq")
    assert 0 < state_rows(machine, tmp_path) <= 5 * 8


CLICK = schemas.AD_CLICK + ", tie BIGINT"


def test_click_cap_over_batches(spark, tmp_path):
    rows = [(n % 2, 1, "p", "c", H + n * 400, n) for n in range(400)]
    batches = thirds(rows, 4) + [[(9, 9, "q", "c", CLOSE, 0)]]
    batch = spark.createDataFrame(rows, CLICK)
    passed, warned = ads.cap_clicks(batch, ["tie"], cap=50)

    def capped(folder):
        return processors.cap_clicks(with_event_time(feed(spark, folder, batches, CLICK)), ["tie"], cap=50)

    split = capped(tmp_path / "in1")
    sinks.split_sink(split, {"pass": f"{tmp_path}/passed", "warn": f"{tmp_path}/warned"},
                     f"{tmp_path}/checkpoint1", "kind", drain=True).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/passed").where("user_id < 9").select(*batch.columns)
    assert table(got) == table(passed)
    warnings = spark.read.parquet(f"{tmp_path}/warned").selectExpr("user_id", "ad_id", "'click over 50times.' AS warning_msg")
    assert table(warnings) == table(warned) != []
    counts = drain(spark, windows.ad_count_by_province(capped(tmp_path / "in2").where("kind = 'pass'")), tmp_path / "run2")
    assert table(counts.where("province = 'p'")) == table(ads.ad_count_by_province(passed))


def test_click_cap_in_a_rolling_cycle(spark, tmp_path):
    batches = [[(1, 1, "p", "c", H + n * 40_000, n) for n in range(3)], [(1, 1, "p", "c", H, 7), (2, 1, "p", "c", H, 8)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, CLICK))
    got = drain(spark, processors.cap_clicks(stream, ["tie"], cap=2, rolling=True), tmp_path)
    assert table(got.select("tie", "kind")) == [(0, "pass"), (1, "pass"), (2, "warn"), (8, "pass")]


def test_rolling_cycles_equal_batch(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.randrange(3), rng.choice([1, 2]), "p", "c", H + rng.randrange(4 * 86_400), n) for n in range(400)]
    batch = spark.createDataFrame(rows, CLICK)
    passed, warned = ads.cap_clicks_from_first(batch, ["tie"], cap=15)
    stream = with_event_time(feed(spark, tmp_path / "in", thirds(rows, 4), CLICK))
    got = drain(spark, processors.cap_clicks(stream, ["tie"], cap=15, rolling=True), tmp_path)
    assert table(got.where("kind = 'pass'").select("tie")) == table(passed.select("tie"))
    pairs = table(got.where("kind = 'warn'").select("user_id", "ad_id"))
    assert pairs == table(warned.select("user_id", "ad_id")) and len(pairs) > len(set(pairs))


@pytest.mark.parametrize("rolling", [True, False])
def test_state_of_the_click_cap_is_kept_by_bucket(spark, tmp_path, monkeypatch, rolling):
    monkeypatch.setattr(processors, "BUCKETS", 8, raising=False)
    batches = [[(n, 1, "p", "c", H + n % 7, n) for n in range(400)], [(n, 1, "p", "c", H + 9, n) for n in range(0, 400, 3)]]
    stream = with_event_time(feed(spark, tmp_path / "in", batches, CLICK))
    capped = processors.cap_clicks(stream, ["tie"], cap=1, rolling=rolling)
    assert 0 < state_rows(capped, tmp_path) <= 5 * 8
    kinds = spark.read.parquet(f"{tmp_path}/out").groupBy("kind").count()
    assert table(kinds) == [("pass", 400), ("warn", 134)]


def test_readers_see_whole_micro_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "k BIGINT, day STRING"
    assert sinks.published(spark, path, schema).count() == 0
    sinks.write_batch(spark.createDataFrame([(1, "a"), (2, "b")], schema), 0, path, ("day",))
    # a crash between the files of a micro-batch and its marker
    sinks.write_batch(spark.createDataFrame([(3, "a"), (4, "c")], schema), 1, path, ("day",))
    os.remove(f"{path}/batch_id=1/_SUCCESS")
    assert sinks.batches(spark, path) == [0]
    assert table(sinks.published(spark, path, schema).select("k")) == [(1,), (2,)]
    # the micro-batch is run again
    sinks.write_batch(spark.createDataFrame([(3, "a"), (4, "c")], schema), 1, path, ("day",))
    seen = sinks.published(spark, path, schema)
    assert table(seen.select("k", "day", "batch_id")) == [(1, "a", 0), (2, "b", 0), (3, "a", 1), (4, "c", 1)]
    assert table(sinks.published(spark, path, schema, after=0).select("k")) == [(3,), (4,)]


def test_versions_as_a_retract_stream(spark):
    versions = spark.createDataFrame([("a", 1, 0), ("a", 3, 2), ("a", 3, 4), ("b", 7, 1)], "k STRING, n BIGINT, batch_id BIGINT")
    story = [("a", 0, True, 1), ("a", 2, False, 1), ("a", 2, True, 3), ("a", 4, False, 3), ("a", 4, True, 3), ("b", 1, True, 7)]
    assert table(sinks.changes(versions, ["k"])) == sorted(story)
    skipped = [entry for entry in story if entry[1] != 4]
    assert table(sinks.changes(versions, ["k"], skip_equal=True)) == sorted(skipped)
    assert table(sinks.latest(versions, ["k"])) == [("a", 3), ("b", 7)]


def test_compacted_versions_give_the_latest_rows(spark, tmp_path):
    path, base, schema = f"{tmp_path}/out", f"{tmp_path}/base", "k BIGINT, v BIGINT"
    now = {}
    for n in range(6):
        rows = {k: 10 * n + k for k in range(n % 3, 6)}
        now.update(rows)
        sinks.write_batch(spark.createDataFrame(list(rows.items()), schema), n, path)
        if n in (2, 4):
            assert sinks.compact(spark, path, base, ["k"], schema) == n
            assert sinks.compact(spark, path, base, ["k"], schema) == n  # nothing new
        assert table(sinks.current(spark, path, base, ["k"], schema)) == sorted(now.items())
    assert sinks.batches(spark, base, "upto") == [2, 4]
    # only the micro-batch after the newest base is read again
    assert sinks.published(spark, path, schema, after=4).select("batch_id").distinct().count() == 1


# --- joins, sinks, sources ---------------------------------------------------------------------


def payment_streams(spark, tmp_path):
    pays = [(n, "pay", f"t{n}", H + n * 10) for n in range(60)]
    receipts = [(f"t{n}", "card", H + n * 10 + n % 12 - 4) for n in range(0, 80, 2)]
    left = with_event_time(feed(spark, tmp_path / "pays", thirds(pays, 3) + [[(999, "pay", "x", CLOSE)]], schemas.ORDER))
    right = with_event_time(feed(spark, tmp_path / "receipts", thirds(receipts, 2) + [[("y", "card", CLOSE)]], schemas.RECEIPT))
    batch = payments.pay_receipt_match(
        spark.createDataFrame(pays, schemas.ORDER), spark.createDataFrame(receipts, schemas.RECEIPT))
    return left, right, batch


def test_reconciled_streams_equal_batch(spark, tmp_path):
    left, right, batch = payment_streams(spark, tmp_path)
    got = drain(spark, joins.reconcile(left, right), tmp_path).where(f"coalesce(order_time, receipt_time) < {CLOSE}")
    kind = lambda name, *columns: table(got.where(f"outcome = '{name}'").select(*columns))
    assert kind("matched", "tx_id", "receipt_time") == table(batch.matched.select("tx_id", "receipt_time")) != []
    assert kind("unmatched-pay", "tx_id") == table(batch.unmatched_pays.select("tx_id")) != []
    assert kind("unmatched-receipt", "tx_id") == table(batch.unmatched_receipts.select("tx_id")) != []


def test_reconciled_streams_of_repeated_ids_equal_batch(spark, tmp_path):
    """Several pays and receipts of one transaction, out of order, and rows without an id."""
    rng = random.Random(7)
    ids = ["a", "b", "c", None, ""]
    pays = [(n, "pay", rng.choice(ids), H + rng.randrange(200)) for n in range(150)]
    receipts = [(rng.choice(ids), f"c{n}", H + rng.randrange(200)) for n in range(150)]
    for rows, at in ((pays, 3), (receipts, 2)):
        rows.sort(key=lambda r: r[at] + rng.random() * 5)
    parts = lambda rows: [rows[:50], rows[50:100], rows[100:]]
    left = with_event_time(feed(spark, tmp_path / "p", parts(pays) + [[(999, "pay", "x", CLOSE)]], schemas.ORDER), "6 seconds")
    right = with_event_time(feed(spark, tmp_path / "r", parts(receipts) + [[("y", "z", CLOSE)]], schemas.RECEIPT), "6 seconds")
    batch = payments.pay_receipt_match(spark.createDataFrame(pays, schemas.ORDER), spark.createDataFrame(receipts, schemas.RECEIPT))
    got = drain(spark, joins.reconcile(left, right), tmp_path).where(f"coalesce(order_time, receipt_time) < {CLOSE}")
    kind = lambda name, *columns: table(got.where(f"outcome = '{name}'").selectExpr("coalesce(tx_id, 'null')", *columns))
    want = lambda df, *columns: table(df.selectExpr("coalesce(tx_id, 'null')", *columns))
    pair = ["order_id", "event_type", "order_time", "pay_channel", "receipt_time"]
    assert kind("matched", *pair) == want(batch.matched, *pair) != []
    assert kind("unmatched-pay", "order_id", "order_time") == want(batch.unmatched_pays, "order_id", "timestamp") != []
    assert kind("unmatched-receipt", "pay_channel", "receipt_time") == want(
        batch.unmatched_receipts, "pay_channel", "timestamp") != []


def test_daily_documents_survive_a_replay(spark, tmp_path):
    left, right, batch = payment_streams(spark, tmp_path)
    documents = document_rows(joins.interval_join(left, right))
    run = lambda: sinks.daily_sink(documents, f"{tmp_path}/out", f"{tmp_path}/checkpoint", max_records=5,
                                   drain=True).awaitTermination()
    read = lambda: spark.read.schema(documents.schema).json(f"{tmp_path}/out").select(*documents.columns)
    run()
    want = table(document_rows(batch.matched))
    assert table(read()) == want != []
    assert max(read().groupBy("_metadata.file_path").count().toPandas()["count"]) <= 5
    # the sink wrote the last batch, but the checkpoint never heard of it
    commits = sorted((f for f in os.listdir(f"{tmp_path}/checkpoint/commits") if f.isdigit()), key=int)
    os.remove(f"{tmp_path}/checkpoint/commits/{commits[-1]}")
    os.remove(f"{tmp_path}/checkpoint/commits/.{commits[-1]}.crc")
    run()
    assert table(read()) == want


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "n").selectExpr("n", "CAST(n % 3 AS STRING) AS day")
    for _ in range(2):
        sinks.write_batch(rows, 4, f"{tmp_path}/out", ("day",), fmt="json")
    assert spark.read.json(f"{tmp_path}/out").count() == 10
    files = sorted(f"{d}/{f}" for d, _, names in os.walk(f"{tmp_path}/out") for f in names)
    sinks.write_batch(rows, 4, f"{tmp_path}/out", ("day",), fmt="json")
    assert files == sorted(f"{d}/{f}" for d, _, names in os.walk(f"{tmp_path}/out") for f in names)
    # a try that broke off: its files are there, the marker is not
    os.remove(f"{tmp_path}/out/batch_id=4/_SUCCESS")
    sinks.write_batch(rows, 4, f"{tmp_path}/out", ("day",), fmt="json")
    assert spark.read.json(f"{tmp_path}/out").count() == 10


def test_lines_to_console_and_memory(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    (folder / "a.txt").write_text(f"1,2,3,pv,{H}\n4,5,6,buy,{H}\n")
    records = decode.decode_user_behavior(lines(spark, [str(folder), "unused"], streaming=True))
    timed = register(with_event_time(records), "stream_view")
    assert timed.isStreaming
    query = sinks.memory_sink(spark.sql("SELECT user_id FROM stream_view WHERE behavior = 'pv'"), "seen")
    query.processAllAvailable()
    query.stop()
    assert table(spark.table("seen")) == [(1,)]
    query = sinks.console_sink(records, "agg")
    assert query.name == "agg"
    query.processAllAvailable()
    query.stop()


def test_named_topics(spark, tmp_path):
    for name in ("OrderEvent", "ReceiptEvent"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_text(name + "\n")
    named = multi_lines(spark, {n: str(tmp_path / n) for n in ("OrderEvent", "ReceiptEvent")})
    assert {k: table(v) for k, v in named.items()} == {n: [(n,)] for n in ("OrderEvent", "ReceiptEvent")}


def test_kafka_options():
    assert kafka_options("host:9092", ["a", "b"]) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "latest"}
    batch = kafka_options("host:9092", ["a"], '{"a":{"0":7}}', streaming=False, maxOffsetsPerTrigger="10")
    assert batch["startingOffsets"] == '{"a":{"0":7}}' and batch["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        kafka_options("host:9092", ["a"], streaming=False)
