"""Keyed state machines for streams.

One class per operator that needs state beyond windows and joins.  Spark splits
the keys, keeps the state in its store and fires the timers; the classes hold
the rules only.  Logins and orders are held back until the watermark has passed them and
taken in event-time order, so the result does not depend on how the input is cut into
micro-batches; the click cap counts arrivals and orders the rows of a micro-batch only.

The state is kept by bucket, a hash of the user, order, transaction or pair: keys of a
handful of rows would cost a call into the state each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplens import outcomes

DAY_S, DAY_MS = 86_400, 86_400_000


#: Keys of the state: hashes of users, orders, transactions, or pairs of a user and an ad.
BUCKETS = 2048

PAIR = ["user_id", "ad_id"]


class ClickCap(StatefulProcessor):
    """Lets the first ``cap`` clicks of a cycle through and warns once.

    The cycle is the UTC day of the click (part of the key), whose state is kept a day
    longer for late clicks; or, if ``rolling``, the 24 hours from the first click of the pair,
    then from the first click after them.  Clicks count as they arrive, those of one
    micro-batch in event-time order; a click of an earlier time counts in the running cycle.

    The state's key is a bucket of pairs, by hash, and is one value: start, clicks that passed
    and whether a warning is out for each pair.
    """

    def __init__(self, cap: int, tie: list[str], rolling: bool, columns: list[str]) -> None:
        self.cap, self.tie, self.rolling, self.columns = cap, tie, rolling, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "pairs STRING, timer BIGINT")

    def _load(self) -> tuple[dict[tuple, list], int | None]:
        if not self.seen.exists():
            return {}, None
        pairs, timer = self.seen.get()
        return {(user, ad): state for user, ad, *state in json.loads(pairs)}, timer

    def _save(self, pairs: dict[tuple, list], timer: int | None, due: int | None) -> None:
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is not None and timer != due:
            self.handle.registerTimer(due)
        if pairs:
            self.seen.update((json.dumps([(*pair, *state) for pair, state in pairs.items()]), due))
        else:
            self.seen.clear()

    def _due(self, pairs: dict[tuple, list]) -> int | None:
        """When the first of the rolling cycles ends."""
        return min(((start + DAY_S) * 1000 for start, _, _ in pairs.values()), default=None)

    def _gathered(self, rows) -> pd.DataFrame:
        """The rows of a bucket, by pair (``_pair``) and in order; of hot pairs those that can matter."""
        keys, held, size, limit = [*PAIR, "timestamp"] if self.rolling else PAIR, [], 0, 200_000
        for chunk in rows:
            held.append(chunk)
            size += len(chunk)
            if size > limit:
                held = [_first(held, keys, self.tie, self.cap + 1)]
                size = len(held[0])
                limit = size + 200_000
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
        frame["_pair"] = frame.groupby(PAIR, dropna=False, sort=False).ngroup()
        return frame.sort_values(["_pair", "timestamp", *self.tie], kind="stable", ignore_index=True)

    def _marked(self, frame: pd.DataFrame, pairs: dict[tuple, list]) -> np.ndarray:
        """1 for the rows that pass and 2 for those that warn; brings ``pairs`` up to date."""
        at, marks = frame["timestamp"].to_numpy(), np.zeros(len(frame), np.int8)
        firsts = np.flatnonzero(np.diff(frame["_pair"].to_numpy(), prepend=-1))
        names = zip(*([None if key != key else key for key in frame[c].iloc[firsts].tolist()] for c in PAIR))
        for pair, begin, end in zip(names, firsts.tolist(), [*firsts[1:].tolist(), len(frame)]):
            start, count, warned = pairs.get(pair, (None, 0, False))
            while begin < end:
                stop = end
                if self.rolling:
                    if start is None or at[begin] >= start + DAY_S:
                        start, count, warned = int(at[begin]), 0, False
                    stop = begin + int(np.searchsorted(at[begin:end], start + DAY_S))
                beyond = begin + self.cap - count
                marks[begin:min(beyond, stop)] = 1
                if beyond < stop:
                    if not warned:
                        marks[beyond] = 2
                    warned = True
                count, begin = min(self.cap, count + stop - begin), stop
            pairs[pair] = [start, count, warned]
        return marks

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        ends = None if self.rolling else (int(key[1]) + 2) * DAY_MS
        frame = self._gathered(rows)
        if ends is not None and ends <= watermark:
            return
        pairs, timer = self._load()
        marks = self._marked(frame, pairs)
        self._save(pairs, timer, self._due(pairs) if self.rolling else ends)
        for mark, kind in ((1, "pass"), (2, "warn")):
            part = frame.loc[marks == mark, self.columns]
            if len(part):
                until = pd.to_datetime(np.maximum(part["timestamp"] * 1000, watermark + 1), unit="ms", utc=True)
                yield part.assign(kind=kind, until=until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.rolling:
            watermark = timerValues.getCurrentWatermarkInMs()
            pairs, timer = self._load()
            pairs = {pair: state for pair, state in pairs.items() if (state[0] + DAY_S) * 1000 > watermark}
            self._save(pairs, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer, self._due(pairs))
        else:
            self.seen.clear()
        return iter([])


def _first(held: list[pd.DataFrame], keys: list[str], tie: list[str], n: int) -> pd.DataFrame:
    rows = pd.concat(held, ignore_index=True).sort_values(["timestamp", *tie], kind="stable")
    return rows.groupby(keys, dropna=False, sort=False).head(n)


def _earliest(clicks: DataFrame, keys: list[str], tie: list[str], n: int) -> DataFrame:
    """The ``n`` first clicks of each key in each task of each micro-batch; no later one can matter."""
    def trim(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size > 200_000:
                best = _first(held, keys, tie, n)
                held, size = [best], len(best)
                if size > 100_000:  # many keys: the rows go on
                    yield best
                    held, size = [], 0
        if held:
            yield _first(held, keys, tie, n)

    return clicks.mapInPandas(trim, clicks.schema)


def cap_clicks(clicks: DataFrame, tie: list[str], cap: int = 100, rolling: bool = False) -> DataFrame:
    """Clicks with ``kind``: pass, or warn for the one click that reports the user.

    A hot pair is trimmed in the tasks that read it: to cap + 1 clicks of a day, or of a
    second in the ``rolling`` form.  The watermarked ``ts`` stops below the operator, so a
    late click counts like any other.
    """
    plain = clicks.drop("ts")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    bucket = F.pmod(F.xxhash64(*PAIR), F.lit(BUCKETS))
    if rolling:
        keyed, keys = _earliest(plain, [*PAIR, "timestamp"], tie, cap + 1), ["_bucket"]
    else:
        dated = plain.withColumn("_day", F.floor(F.col("timestamp") / DAY_S))
        keyed, keys = _earliest(dated, [*PAIR, "_day"], tie, cap + 1), ["_bucket", "_day"]
    # later windows need the event time of what comes out; it is never behind the watermark
    return keyed.withColumn("_bucket", bucket).groupBy(*keys).transformWithStateInPandas(
        ClickCap(cap, tie, rolling, plain.columns), f"{fields}, kind STRING, until TIMESTAMP", "append", "eventTime",
        eventTimeColumnName="until")


def click_warnings(capped: DataFrame, cap: int = 100) -> DataFrame:
    return capped.where("kind = 'warn'").select(
        "user_id", "ad_id", F.lit(outcomes.click_warning(cap)).alias("warning_msg"))


WARNING = "user_id BIGINT, first_fail_time BIGINT, last_fail_time BIGINT, warning_msg STRING"
FailWarning = Row("user_id", "first_fail_time", "last_fail_time", "warning_msg")

RESULT = "order_id BIGINT, result_state STRING, is_timeout_side BOOLEAN"
Result = Row("order_id", "result_state", "is_timeout_side")


class InEventTimeOrder(StatefulProcessor):
    """Holds rows back until the watermark has passed them, then steps through them in order.

    Users, orders or transactions number as many as the rows, and a call into the state for each
    costs far more than its rows do.  So the state's key is a bucket of them, by hash: a bucket
    is one value and has one timer, for the first second at which there is work: a row that the
    watermark reaches, or a deadline of what waits.  A micro-batch costs a bucket two reads, two
    writes and one timer at most; within it every user, order or transaction is stepped through
    by itself.  A subclass keeps a list of partial matches for each, and implements ``taken``
    (what to keep of an input row, its time first), ``step`` (one row) and ``expire`` (the
    watermark moved).
    """

    output: Row

    def __init__(self, key: str) -> None:
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "members STRING, timer BIGINT")

    def step(self, partial: list[tuple], row: tuple) -> tuple[list[tuple], list[tuple]]:
        raise NotImplementedError

    def expire(self, partial: list[tuple], watermark_ms: int) -> tuple[list[tuple], list[tuple]]:
        return partial, []

    def deadlines(self, partial: list[tuple]) -> set[int]:
        """Times in milliseconds at which ``expire`` has work to do."""
        return set()

    def taken(self, row: Row) -> tuple:
        raise NotImplementedError

    def in_order(self, held: list[tuple]) -> list[tuple]:
        return sorted(held)

    def _load(self) -> tuple[dict, int | None]:
        """Rows held back and partial matches of each member of the bucket, and the bucket's timer."""
        if not self.kept.exists():
            return {}, None
        members, timer = self.kept.get()
        return {member: ([tuple(row) for row in held], [tuple(row) for row in partial])
                for member, held, partial in json.loads(members)}, timer

    def _save(self, members: dict, timer: int | None) -> None:
        due = min((at for held, partial in members.values()
                   for at in (*(row[0] * 1000 for row in held), *self.deadlines(partial))), default=None)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is not None and timer != due:
            self.handle.registerTimer(due)
        if members:
            self.kept.update((json.dumps([(member, *rows) for member, rows in members.items()]), due))
        else:
            self.kept.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        members, timer = self._load()
        for row in rows:
            members.setdefault(row[self.key], ([], []))[0].append(self.taken(row))
        self._save(members, timer)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        members, timer = self._load()
        results, left = [], {}
        for member, (held, partial) in members.items():
            for row in self.in_order([row for row in held if row[0] * 1000 <= watermark]):
                partial, found = self.step(partial, row)
                results += [(member, *result) for result in found]
            partial, found = self.expire(partial, watermark)
            results += [(member, *result) for result in found]
            later = [row for row in held if row[0] * 1000 > watermark]
            if later or partial:
                left[member] = later, partial
        self._save(left, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        for result in results:
            yield self.output(*result)


def _in_order(rows: DataFrame, processor: InEventTimeOrder, schema: str) -> DataFrame:
    """``processor`` over the rows, which keep the watermarked ``ts``."""
    bucket = F.pmod(F.xxhash64(processor.key), F.lit(BUCKETS))
    return rows.withColumn("_bucket", bucket).groupBy("_bucket").transformWithState(processor, schema, "append", "eventTime")


class LoginFailTimer(InEventTimeOrder):
    """A window opened by the first failure, cancelled by a success, checked at its end."""

    output = FailWarning

    def __init__(self, tie: str, max_fail: int, within_s: int) -> None:
        super().__init__("user_id")
        self.tie, self.max_fail, self.within_s = tie, max_fail, within_s

    def taken(self, row: Row) -> tuple:
        return row.timestamp, row[self.tie], row.login_state == "fail"

    def _warnings(self, windows: list[tuple]) -> list[tuple]:
        return [(anchor, last, f"{outcomes.login_window_warning(self.within_s)}{n} times")
                for anchor, n, last in windows if n >= self.max_fail]

    def step(self, partial, row):
        at, _, failed = row
        found = []
        if partial and at > partial[0][0] + self.within_s:
            found, partial = self._warnings(partial), []
        if not failed:
            return [], found
        anchor, n, _ = partial[0] if partial else (at, 0, at)
        return [(anchor, n + 1, at)], found

    def expire(self, partial, watermark_ms):
        if partial and (partial[0][0] + self.within_s) * 1000 <= watermark_ms:
            return [], self._warnings(partial)
        return partial, []

    def deadlines(self, partial):
        return {(anchor + self.within_s) * 1000 for anchor, _, _ in partial}


def login_fail_window(logins: DataFrame, tie: str, max_fail: int = 5, within_s: int = 5) -> DataFrame:
    rows = logins.select("user_id", "timestamp", tie, "login_state", "ts")
    return _in_order(rows, LoginFailTimer(tie, max_fail, within_s), WARNING)


class OrderPayMonitor(InEventTimeOrder):
    """What waits is a create with its deadline, or a pay for the rest of its second."""

    output = Result

    def __init__(self, timeout_s: int) -> None:
        super().__init__("order_id")
        self.timeout_s = timeout_s

    def taken(self, row: Row) -> tuple:
        return row.timestamp, row.event_type  # create sorts before pay

    def _expired(self, partial: list[tuple]) -> list[tuple]:
        return [(outcomes.NO_CREATE if paid else outcomes.TIMEOUT, True) for paid, _ in partial]

    def step(self, partial, row):
        at, kind = row
        found = []
        if partial and at > partial[0][1]:
            found, partial = self._expired(partial), []
        if kind == "create":
            return [(False, at + self.timeout_s)], found
        if partial and not partial[0][0]:
            late = at == partial[0][1]
            return [], found + [(outcomes.PAID_LATE if late else outcomes.PAID, late)]
        return [(True, at)], found

    def expire(self, partial, watermark_ms):
        if partial and partial[0][1] * 1000 <= watermark_ms:
            return [], self._expired(partial)
        return partial, []

    def deadlines(self, partial):
        return {deadline * 1000 for _, deadline in partial}


def order_pay_monitor(orders: DataFrame, timeout_s: int = 900) -> DataFrame:
    """The rules of the batch form, each row taken once the watermark has passed it."""
    known = orders.where(F.when(F.col("ts").isNotNull(), F.col("event_type").isin("create", "pay")))
    rows = known.select("order_id", "timestamp", "event_type", "ts")
    return _in_order(rows, OrderPayMonitor(timeout_s), RESULT)


class LoginFailPattern(InEventTimeOrder):
    """The last failures in a row, oldest first; a success empties them."""

    output = FailWarning

    def __init__(self, tie: str, times: int, within_s: int) -> None:
        super().__init__("user_id")
        self.tie, self.times, self.within_s = tie, times, within_s

    def taken(self, row: Row) -> tuple:
        return row.timestamp, row[self.tie], row.login_state == "fail"

    def step(self, partial, row):
        at, _, failed = row
        if not failed:
            return [], []
        run = [*partial, (at,)]
        found = []
        if len(run) >= self.times:
            run = run[-self.times:]
            if at - run[0][0] < self.within_s:
                found = [(run[0][0], at, outcomes.login_run_warning(self.times))]
        return run[-(self.times - 1):], found

    def expire(self, partial, watermark_ms):
        """A run the watermark has left ``within_s`` behind cannot take part in a match."""
        if partial and (partial[-1][0] + self.within_s) * 1000 <= watermark_ms:
            return [], []
        return partial, []

    def deadlines(self, partial):
        return {(partial[-1][0] + self.within_s) * 1000} if partial else set()


def login_fail_consecutive(logins: DataFrame, tie: str, times: int = 3, within_s: int = 5) -> DataFrame:
    rows = logins.select("user_id", "timestamp", tie, "login_state", "ts")
    return _in_order(rows, LoginFailPattern(tie, times, within_s), WARNING)


class OrderPayPattern(InEventTimeOrder):
    """Open creates; a pay matches them all, age times them out."""

    output = Result

    def __init__(self, within_s: int) -> None:
        super().__init__("order_id")
        self.within_s = within_s

    def taken(self, row: Row) -> tuple:
        return row.timestamp, row.event_type == "pay"

    def step(self, partial, row):
        at, is_pay = row
        partial, found = self.expire(partial, at * 1000)
        if is_pay:
            return [], found + [(outcomes.PAIRED, False)] * len(partial)
        return [*partial, (at,)], found

    def expire(self, partial, watermark_ms):
        ends = [(create[0] + self.within_s) * 1000 for create in partial]
        found = [(f"{outcomes.TIMEOUT}{end}", True) for end in ends if end <= watermark_ms]
        return [c for c, end in zip(partial, ends) if end > watermark_ms], found

    def deadlines(self, partial):
        return {(create[0] + self.within_s) * 1000 for create in partial}


def order_pay_pattern(orders: DataFrame, within_s: int = 300) -> DataFrame:
    """P4 rows (``is_timeout_side`` false) and P5 rows (true)."""
    known = orders.where(F.when(F.col("ts").isNotNull(), F.col("event_type").isin("create", "pay")))
    rows = known.select("order_id", "timestamp", "event_type", "ts")
    return _in_order(rows, OrderPayPattern(within_s), RESULT)


RECONCILED = ("tx_id STRING, outcome STRING, order_id BIGINT, event_type STRING, order_time BIGINT, "
              "pay_channel STRING, receipt_time BIGINT")
ReconciledRow = Row(*(field.split()[0] for field in RECONCILED.split(", ")))


class PayReceiptMatch(InEventTimeOrder):
    """The last row of a transaction waits for one of the other side, or is left over."""

    output = ReconciledRow

    def __init__(self, before_s: int, after_s: int) -> None:
        super().__init__("tx_id")
        self.before_s, self.after_s = before_s, after_s

    def taken(self, row: Row) -> tuple:
        return row.timestamp, row.is_receipt, row.order_id, row.event_type, row.pay_channel

    def in_order(self, held):
        """Pays before receipts in one second, nulls first, as in the batch form."""
        return sorted(held, key=lambda row: [(value is not None, value) for value in row])

    def _end(self, row: tuple) -> int:
        """The last second in which a partner may come."""
        return row[0] + (self.before_s if row[1] else self.after_s)

    def _alone(self, row: tuple) -> tuple:
        at, receipt, order_id, event_type, channel = row
        if receipt:
            return "unmatched-receipt", None, None, None, channel, at
        return "unmatched-pay", order_id, event_type, at, None, None

    def step(self, partial, row):
        if not partial:
            return [row], []
        waiting = partial[0]
        if waiting[1] == row[1] or row[0] > self._end(waiting):
            return [row], [self._alone(waiting)]
        pay, receipt = (waiting, row) if row[1] else (row, waiting)
        return [], [("matched", pay[2], pay[3], pay[0], receipt[4], receipt[0])]

    def expire(self, partial, watermark_ms):
        if partial and self._end(partial[0]) * 1000 <= watermark_ms:
            return [], [self._alone(partial[0])]
        return partial, []

    def deadlines(self, partial):
        return {self._end(row) * 1000 for row in partial}


def pay_receipt_match(rows: DataFrame, before_s: int = 3, after_s: int = 5) -> DataFrame:
    """The rules of the batch form, over the rows of both sides with ``is_receipt``."""
    return _in_order(rows, PayReceiptMatch(before_s, after_s), RECONCILED)
