"""Packing documents into token sequences by minimum bin slack.

A document is its ids and an end id.  One longer than a sequence is cut into whole
sequences, of which the first piece may be shorter.  Pieces that fill a sequence take
one each.  The rest is packed bin by bin: the longest piece left opens the bin, a
bitset over reachable sums finds the fullest combination of the lengths left beside
it, and the combination is removed.

All that the search needs is how many pieces there are of each length, at most
``CAPACITY`` numbers whatever the input.  The same combination comes out again while
all its lengths are left often enough, so it is taken that many times at once.  Pieces
of one length are interchangeable: each gets a number within its length from counts
per task, and the number tells sequence and offset.  No piece passes the driver.

Defined results: a null or empty text is the end id alone; repeated rows are packed
like others; no rows give no pieces; further columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.common import keep, pieces as small_batches
from shoplens.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
_END = END_ID.to_bytes(4, "little")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, longest first, whose sum is the largest within ``room``; none is used more often than there is."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, part = min(counts[length], room // length), 1
        while left and not reach >> room & 1:  # 1, 2, 4, ... copies at a time
            times = min(part, left)
            steps.append((length, times, reach))
            reach |= reach << length * times & mask
            left, part = left - times, part * 2
        if reach >> room & 1:
            break
    target, used = reach.bit_length() - 1, []
    for length, times, before in reversed(steps):
        if not before >> target & 1:
            used += [length] * times
            target -= length * times
    return sorted(used, reverse=True)


def minimum_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how often each is taken, until no length is left."""
    left = {length: n for length, n in histogram.items() if n > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must be between 1 and the capacity")
    bins: list[tuple[list[int], int]] = []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest({length: n for length, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        combination = [longest, *rest]
        need: dict[int, int] = {}
        for length in combination:
            need[length] = need.get(length, 0) + 1
        times = min(left[length] // n for length, n in need.items())
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bins.append((combination, times))
    return bins


def places(bins: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """Per length rows of (first number, first sequence, copies in the sequence, offset), by first number."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for combination, times in bins:
        offset, at = 0, 0
        while at < len(combination):
            length = combination[at]
            copies = combination.count(length)
            first = taken.get(length, 0)
            rows.setdefault(length, []).append((first, sequence, copies, offset))
            taken[length] = first + copies * times
            offset, at = offset + copies * length, at + copies
        sequence += times
    return {length: np.array(found, np.int64) for length, found in rows.items()}


def _cut(docs: DataFrame, capacity: int, folder: str | None, keep_ids: bool) -> DataFrame:
    """One row per piece; ``task`` and ``nth`` number the pieces of a length within the task that made them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(folder).packed, TaskContext.get().partitionId(), {}
        for batch in small_batches(batches):
            source, rows, chunks = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = (encode(text) if text else b"") + _END
                total = len(ids) // 4
                begin, piece = 0, 0
                while begin < total:
                    end = total - (total - begin - 1) // capacity * capacity
                    chunk = ids[4 * begin:4 * end]
                    length = end - begin
                    nth = seen[length] = seen.get(length, -1) + 1
                    source.append(row)
                    rows.append((piece, begin, length, zlib.crc32(chunk), task, nth))
                    if keep_ids:
                        chunks.append(chunk)
                    begin, piece = end, piece + 1
            columns = zip(*rows) if rows else [[]] * 6
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            out = [batch.column(0).take(pa.array(source, pa.int64()))]
            out += [pa.array(c, k) for c, k in zip(columns, kinds)]
            if keep_ids:
                out.append(pa.array(chunks, pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = docs.select("doc_id").schema
    for name, kind in [("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"),
                       ("task", "integer"), ("nth", "long")] + [("ids", "binary")] * keep_ids:
        schema = schema.add(name, kind)
    names = schema.names
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; with ``keep_ids`` also their ids as unsigned 32-bit bytes."""
    cut = keep(spark, _cut(docs, capacity, folder, keep_ids), "pieces")
    counts = keep(spark, cut.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = places(minimum_slack(histogram, capacity))

    # where the numbers of a task begin within a length: one row per length and task
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    numbered = cut.join(begins, ["length", "task"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            lengths = column["length"].to_numpy()
            numbers = column["nth"].to_numpy() + column["begin"].to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                table = slots[length]
                row = table[np.searchsorted(table[:, 0], numbers[at], "right") - 1]
                copy, slot = np.divmod(numbers[at] - row[:, 0], row[:, 2])
                sequence[at] = row[:, 1] + copy
                offset[at] = row[:, 3] + slot * length
            yield pa.RecordBatch.from_arrays(
                [*(column[name] for name in shown), pa.array(sequence), pa.array(offset)],
                names=[*shown, "sequence_id", "offset"])

    shown = [name for name in cut.columns if name not in ("task", "nth")]
    schema = cut.select(*shown).schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(place, schema)
