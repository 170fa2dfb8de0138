"""Sliding windows, late rows and running counts kept in the engine's state.

Spark's own window state closes by its own bounds: a pane that is behind the watermark
takes no more rows, although windows that hold it are still open.  Here a key keeps a
ring of panes, as long as any window of theirs may take rows, and every window decides
for itself whether it is open.

* Rows are counted per key and pane in each task before the shuffle, so a hot key sends
  one row per task and pane.
* The panes of a key are one value of the state: one read and one write per micro-batch
  and key, of at most (size + delay + lateness) / slide numbers.
* A key has one timer, for its next window.  What a window gives out is written as spans
  of windows with equal counts and expanded afterwards, by Spark's own expressions.

The watermarked column ``ts`` stops below these operators.  They see rows that Spark
would drop there, and compare them with the watermark themselves: a window is closed
when the watermark has reached its last millisecond, and takes rows until the watermark
has passed that by the allowed lateness.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplens.functions.bitmap import bit_offset
from shoplens.functions.filters import constant_key
from shoplens.operators.windows import floor_to, to_seconds

#: Numbers of a running count that are written out by one task.
PIECE = 1 << 16


def _moment(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc)


def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``n``: rows per key, combined within each task of each micro-batch."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            some = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            some = some.select([*keys, "count_all"]).rename_columns([*keys, "n"])
            held = some if held is None else pa.concat_tables([held, some])
            if held.num_rows > 100_000:
                held = _summed(held, keys)
                if held.num_rows > 50_000:  # no use holding on to them
                    yield from held.to_batches()
                    held = None
        if held is not None and held.num_rows:
            yield from _summed(held, keys).to_batches()

    rows = rows.select(*keys)
    return rows.mapInArrow(combine, T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())]))


def _summed(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.group_by(keys).aggregate([("n", "sum")]).select([*keys, "n_sum"]).rename_columns([*keys, "n"])


class SlidingCounts(StatefulProcessor):
    """Counts of sliding windows of one key: spans of windows with one count, and the count given out before."""

    def __init__(self, size_s: int, slide_s: int, lateness_s: int, rows_of: Row) -> None:
        self.size, self.slide, self.lateness, self.row = size_s, slide_s, lateness_s, rows_of

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("panes", "panes BINARY, given BIGINT, timer BIGINT")

    def _load(self, closed: int) -> tuple[dict[int, int], int, int | None]:
        if not self.kept.exists():
            return {}, closed, None
        raw, given, timer = self.kept.get()
        numbers = array("q", bytes(raw))
        return dict(zip(numbers[::2], numbers[1::2])), given, timer

    def _save(self, panes: dict[int, int], given: int, timer: int | None, gone: int) -> None:
        """Keeps the panes that some window may still need, and one timer for the next window."""
        panes = {at: n for at, n in panes.items() if at + self.size > gone}
        due = min((max(at, given) + self.slide for at in panes if at + self.size > given), default=None)
        if due is None and panes:  # all windows are given out; the last one ends the panes when it takes no more rows
            due = max(panes) + self.size + self.lateness
        at = None if due is None else due * 1000 - 1
        if timer is not None and timer != at:
            self.handle.deleteTimer(timer)
        if at is not None and timer != at:
            self.handle.registerTimer(at)
        if panes:
            self.kept.update((array("q", [x for item in panes.items() for x in item]).tobytes(), given, at))
        else:
            self.kept.clear()

    def _spans(self, panes: dict[int, int], after: int, upto: int) -> Iterator[tuple[int, int, int]]:
        """(first, last, count) of the windows with rows that end after ``after``, up to ``upto``."""
        steps: dict[int, int] = {}
        for at, n in panes.items():
            steps[at + self.slide] = steps.get(at + self.slide, 0) + n
            steps[at + self.size + self.slide] = steps.get(at + self.size + self.slide, 0) - n
        level, ends = 0, sorted(steps)
        for begin, end in zip(ends, ends[1:]):
            level += steps[begin]
            first, last = max(begin, after + self.slide), min(end - self.slide, upto)
            if level and first <= last:
                yield first, last, level

    def _bounds(self, timer_values) -> tuple[int, int]:
        """The last window that is closed, and the last that takes no more rows, by their ends."""
        watermark = timer_values.getCurrentWatermarkInMs()
        floor = lambda ms: (ms + 1) // 1000 // self.slide * self.slide
        return floor(watermark), floor(watermark - self.lateness * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        closed, gone = self._bounds(timerValues)
        panes, given, timer = self._load(closed)
        out = [(*span, None) for span in self._spans(panes, given, closed)]
        given = max(given, closed)
        new: dict[int, int] = {}
        for row in rows:
            if row.pane + self.size > gone:
                new[row.pane] = new.get(row.pane, 0) + row.n
        if new and gone < closed:
            out += self._corrected(panes, new, gone, closed)
        for at, n in new.items():
            panes[at] = panes.get(at, 0) + n
        self._save(panes, given, timer, gone)
        for span in out:
            yield self.row(*key, *span)

    def _corrected(self, panes: dict, new: dict, gone: int, closed: int) -> Iterator[tuple]:
        """Windows already given out that new rows reach in time, with the count before (null if there was none)."""
        steps: dict[int, list[int]] = {}
        for which, counts in enumerate((panes, new)):
            for at, n in counts.items():
                for place, change in ((at + self.slide, n), (at + self.size + self.slide, -n)):
                    steps.setdefault(place, [0, 0])[which] += change
        before, more, ends = 0, 0, sorted(steps)
        for begin, end in zip(ends, ends[1:]):
            before, more = before + steps[begin][0], more + steps[begin][1]
            first, last = max(begin, gone + self.slide), min(end - self.slide, closed)
            if more and first <= last:
                yield first, last, before + more, before or None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        closed, gone = self._bounds(timerValues)
        panes, given, timer = self._load(closed)
        out = [(*span, None) for span in self._spans(panes, given, closed)]
        fired = expiredTimerInfo.getExpiryTimeInMs()
        self._save(panes, max(given, closed), None if fired == timer else timer, gone)
        for span in out:
            yield self.row(*key, *span)


def sliding_counts(rows: DataFrame, keys: list[str], size: str, slide: str, lateness: str = "0 seconds",
                   every_version: bool = False) -> DataFrame:
    """Keys, ``window_end``, ``count`` of every window the watermark has closed.

    Rows that come later still count in the windows that are open.  With ``lateness`` a
    closed window takes rows until the watermark is that far beyond it, and is given out
    again; ``every_version`` adds the count ``before``, null for the first one.
    """
    size_s, slide_s = to_seconds(size), to_seconds(slide)
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    named = keys or ["_all"]
    source = rows if keys else rows.withColumn("_all", F.lit(0))
    panes = counted(source.withColumn("pane", floor_to("timestamp", slide_s).cast("bigint")), [*named, "pane"])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in panes.schema.fields if f.name in named]
    schema = ", ".join([*fields, "first BIGINT", "last BIGINT", "count BIGINT", "before BIGINT"])
    processor = SlidingCounts(size_s, slide_s, to_seconds(lateness), Row(*named, "first", "last", "count", "before"))
    spans = panes.groupBy(*named).transformWithState(processor, schema, "append", "eventTime")
    ends = F.explode(F.sequence("first", "last", F.lit(slide_s).cast("bigint")))
    versions = spans.select(*keys, ends.alias("_end"), "count", "before").select(
        *keys, (F.col("_end") * 1000).alias("window_end"), "count", "before")
    return versions if every_version else versions.drop("before")


def retractions(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Versions as a retract stream: ``added`` false takes the count before back, true puts the new one in."""
    old = F.struct(F.lit(False).alias("added"), F.col("before").alias("count"))
    new = F.struct(F.lit(True).alias("added"), F.col("count"))
    entries = F.filter(F.array(old, new), lambda e: e["count"].isNotNull())
    return versions.select(*keys, "window_end", F.inline(entries))


# --- A6: rows too late for every window ----------------------------------------------------------


class LateRows(StatefulProcessor):
    """Marks rows whose newest window takes no more rows.  The watermark is the engine's; nothing else is kept."""

    def __init__(self, size_s: int, slide_s: int, lateness_s: int) -> None:
        self.size, self.slide, self.lateness = size_s, slide_s, lateness_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for chunk in rows:
            newest = chunk["timestamp"] // self.slide * self.slide + self.size
            yield chunk.drop(columns="_shard", errors="ignore").assign(late=(newest + self.lateness) * 1000 - 1 <= watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter([])


def mark_late(rows: DataFrame, size: str = "10 minutes", slide: str = "5 seconds", lateness: str = "1 minute",
              shards: int = 16) -> DataFrame:
    """Every row with ``late``, true where no window takes it any more; the watermarked ``ts`` goes."""
    plain = rows.drop("ts")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    shard = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in plain.columns)), F.lit(shards))
    return plain.withColumn("_shard", shard).groupBy("_shard").transformWithStateInPandas(
        LateRows(to_seconds(size), to_seconds(slide), to_seconds(lateness)), f"{fields}, late BOOLEAN", "append", "eventTime")


# --- A11, A12: running counts per window ---------------------------------------------------------

PAGE_BITS = 15  # bits of the visitor bitmap that are one value of the state


class NewBits(StatefulProcessor):
    """One page of the visitor bitmap of one window: how many of the bits that come are new."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "bits BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark, end = timerValues.getCurrentWatermarkInMs(), key[0]
        if end - 1 <= watermark:
            return
        had = self.page.exists()
        bits = np.frombuffer(bytes(self.page.get()[0]), np.uint8).copy() if had else np.zeros(1 << (PAGE_BITS - 3), np.uint8)
        before = int(np.bitwise_count(bits).sum())
        for row in rows:
            bits |= np.frombuffer(bytes(row.bits), np.uint8)
        self.page.update((bits.tobytes(),))
        if not had:
            self.handle.registerTimer(end - 1)
        new = int(np.bitwise_count(bits).sum()) - before
        if new:
            yield Row(window_end=end, n=new, until=_moment(end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.page.clear()
        return iter([])


class Totals(StatefulProcessor):
    """The count of a window so far; gives out the numbers that new rows take, in pieces."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[0]
        if end - 1 <= timerValues.getCurrentWatermarkInMs():
            return
        had = self.total.exists()
        before = self.total.get()[0] if had else 0
        now = before + sum(row.n for row in rows)
        self.total.update((now,))
        if not had:
            self.handle.registerTimer(end - 1)
        for at in range(before + 1, now + 1, PIECE):
            yield Row(window_end=end, first=at, last=min(at + PIECE - 1, now))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.total.clear()
        return iter([])


def _numbered(parts: DataFrame, label: str) -> DataFrame:
    """One row per number that the rows of a micro-batch take in their window; a large window is written by many tasks."""
    spans = parts.groupBy("window_end").transformWithState(
        Totals(), "window_end BIGINT, first BIGINT, last BIGINT", "append", "eventTime")
    return spans.repartition(F.col("window_end"), F.col("first")).select(
        constant_key(label, "url"), "window_end", F.explode(F.sequence("first", "last")).alias("count"))


def _window_end(size: str) -> Column:
    return ((floor_to("timestamp", to_seconds(size)) + to_seconds(size)) * 1000).cast("bigint")


def running_views(views: DataFrame, size: str = "1 hour") -> DataFrame:
    """The running count of a window at each of its rows -> url, window_end, count.

    Tasks count their rows of a window, the state holds one number per window, and the
    numbers that the rows of a micro-batch take are made from that.
    """
    return _numbered(counted(views.select(_window_end(size).alias("window_end")), ["window_end"]), "pv")


def _pages(bits: DataFrame) -> DataFrame:
    """``window_end``, ``page`` and the bits set in it, put together within each task of each micro-batch."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.int64()),
                 pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())],
                names=["window_end", "page", "bits"])

        for batch in batches:
            bit = batch.column(1).to_numpy()
            frame = pd.DataFrame({"end": batch.column(0).to_numpy(), "page": bit >> PAGE_BITS, "at": bit & ((1 << PAGE_BITS) - 1)})
            for key, at in frame.groupby(["end", "page"])["at"]:
                held.setdefault(key, np.zeros(1 << PAGE_BITS, bool))[at.to_numpy()] = True
            if len(held) > 2000:
                yield out()
                held.clear()
        if held:
            yield out()

    return bits.mapInArrow(combine, "window_end long, page long, bits binary")


def running_visitors(views: DataFrame, size: str = "1 hour", bits: int = 29, seed: int = 61) -> DataFrame:
    """The running visitor count of a window at every new bit of its bitmap -> url, window_end, count."""
    marked = views.select(_window_end(size).alias("window_end"), bit_offset("user_id", bits, seed).alias("bit"))
    new = _pages(marked).groupBy("window_end", "page").transformWithState(
        NewBits(), "window_end BIGINT, n BIGINT, until TIMESTAMP", "append", "eventTime", eventTimeColumnName="until")
    return _numbered(new.select("window_end", "n"), "uv")


# --- A3: ranks of each window as a retract stream ------------------------------------------------


class RankChanges(StatefulProcessor):
    """The ``n`` largest counts of a window; gives out the ranks that change.

    Counts only grow, so an id that is not among the first and gets no new count stays out:
    the state is the ``n`` rows.
    """

    def __init__(self, n: int, id_col: str) -> None:
        self.n, self.id_col = n, id_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getValueState("top", "ids BINARY, until BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        had = self.top.exists()
        numbers = array("q", bytes(self.top.get()[0])) if had else array("q")
        old = list(zip(numbers[::2], numbers[1::2]))
        counts, until = dict(old), 0
        for row in rows:
            counts[row[self.id_col]] = max(row["count"], counts.get(row[self.id_col], 0))
            until = max(until, row.until)
        new = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:self.n]
        until = max(until, timerValues.getCurrentWatermarkInMs() + 1)
        if had and self.top.get()[1] != until:
            self.handle.deleteTimer(self.top.get()[1])
        self.handle.registerTimer(until)
        self.top.update((array("q", [x for item in new for x in item]).tobytes(), until))
        for rank in range(max(len(old), len(new))):
            was, now = (rows[rank] if rank < len(rows) else None for rows in (old, new))
            if was != now:
                for added, item in ((False, was), (True, now)):
                    if item is not None:
                        yield Row(*(self.id_col, "window_end", "cnt", "row_num", "added"))(
                            item[0], key[0], item[1], rank + 1, added)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.top.clear()
        return iter([])


def _leading(counts: DataFrame, id_col: str, n: int) -> DataFrame:
    """Of each window the ``n`` largest counts of each task of each micro-batch."""
    def trim(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            best = frame if best is None else pd.concat([best, frame], ignore_index=True)
            best = best.sort_values(["count", id_col], ascending=[False, True])
            best = best.drop_duplicates(["window_end", id_col]).groupby("window_end").head(n)
        if best is not None:
            yield best

    return counts.mapInPandas(trim, counts.schema)


def rank_changes(versions: DataFrame, id_col: str, n: int = 5, lateness: str = "0 seconds") -> DataFrame:
    """A3: ``id_col`` (an integer), window_end, cnt, row_num, added, from the ``every_version`` form of the counts."""
    until = F.col("window_end") + to_seconds(lateness) * 1000
    rows = _leading(versions.select("window_end", id_col, "count", until.alias("until")), id_col, n)
    schema = f"{id_col} BIGINT, window_end BIGINT, cnt BIGINT, row_num INT, added BOOLEAN"
    return rows.groupBy("window_end").transformWithState(RankChanges(n, id_col), schema, "append", "eventTime")
