"""Line deduplication with two Bloom filters.

Pass 1 puts the hash of every line key into a filter of keys seen once or, when the
key was there already, into a second one of keys seen twice; each task does this for
its rows, and the filters of all tasks are merged segment by segment (a key that two
tasks saw has all its bits in both).  Pass 2 asks the second filter: only keys that
it holds leave their task, one row per key and document, to be counted exactly.
A filter that is too small only makes more keys suspects; results are exact.

A filter's size follows the number of documents up to ``MAX_BITS``, the proven bound
of what is handed to the executors.

A key is a line without the white space around it, A-Z in lower case.  Empty keys
are never dropped.  ``keep_first`` spares the first occurrence (smallest id, then
hash of the document, then line); without it a frequent key loses all its lines.

Defined results: a null or empty text is one empty line; rows that agree in id and
text count as so many documents and get the same result; null ids are allowed.  Texts and
lines of any length are taken whole; a text is held by one task.  An empty table gives no
rows.  Columns named like ``ADDED`` are replaced, others passed through.  Only documents
that may lose a line are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import KEY, binaries, keep, own_columns, pieces, row_key, text_bytes

MAX_BITS = 1 << 29  # of each filter: 64 MB
SEGMENT_BYTES = 1 << 16  # merged one segment of each filter at a time
PROBES = 3
MIN_DOCUMENTS = 10
ADDED = ["_n_lines", "_n_dropped"]


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # of bytes: ASCII only


def _probes(keys: list[bytes], bits: int) -> np.ndarray:
    """Bit numbers, one row per key, from two halves of one hash."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(bits)


def filter_bits(documents: int) -> int:
    """Bits of each filter: a power of two, 128 or more a document, at most ``MAX_BITS``."""
    return 1 << max(20, min(MAX_BITS.bit_length() - 1, (128 * max(documents, 1) - 1).bit_length()))


def _holds(filter_: np.ndarray, probes: np.ndarray) -> np.ndarray:
    return (filter_[probes >> np.uint64(3)] >> (probes & np.uint64(7)).astype(np.uint8) & 1).all(1)


def _add(filter_: np.ndarray, probes: np.ndarray) -> None:
    flat = probes.ravel()
    np.bitwise_or.at(filter_, flat >> np.uint64(3), np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


def _local_filters(docs: DataFrame, bits: int) -> DataFrame:
    """Segments of the filters of each task, as packed bits."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in pieces(batches):
            keys: dict[bytes, int] = {}
            for raw in binaries(batch.column(0)):
                for key in set(map(line_key, raw.split(b"\n"))):
                    keys[key] = keys.get(key, 0) + 1
            keys.pop(b"", None)
            if keys:
                probes = _probes(list(keys), bits)
                again = _holds(once, probes) | (np.fromiter(keys.values(), np.int64, len(keys)) > 1)
                _add(twice, probes[again])
                _add(once, probes)
        for number, start in enumerate(range(0, bits // 8, SEGMENT_BYTES)):
            parts = [x[start:start + SEGMENT_BYTES] for x in (once, twice)]
            if parts[0].any():
                packed = [zlib.compress(x.tobytes(), 1) for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                    names=["segment", "once", "twice"])

    return docs.select(text_bytes().alias("raw")).mapInArrow(build, "segment int, once binary, twice binary")


def seen_twice(docs: DataFrame, bits: int) -> DataFrame:
    """The merged second filter, one row per segment."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            packed = zlib.compress(twice.tobytes(), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([packed], pa.binary())], names=["segment", "twice"])

        for batch in batches:
            for number, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if number != current:
                    if current is not None:
                        yield done()
                    current, once, twice = number, a, b
                else:
                    once, twice = once | a, twice | b | (once & a)
        if current is not None:
            yield done()

    parts = _local_filters(docs, bits).repartition("segment").sortWithinPartitions("segment")
    return parts.mapInArrow(merge, "segment int, twice binary")


def suspects(spark: SparkSession, docs: DataFrame, bits: int | None = None) -> DataFrame:
    """One row per document and key that the second filter holds: key of the document, line key, line numbers."""
    bits = bits or filter_bits(docs.count())
    segments = {r["segment"]: r["twice"] for r in seen_twice(docs, bits).collect()}  # bits / 8 bytes at most
    shared = spark.sparkContext.broadcast(segments)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.zeros(bits // 8, np.uint8)
        for number, packed in shared.value.items():
            found = np.frombuffer(zlib.decompress(packed), np.uint8)
            twice[number * SEGMENT_BYTES:number * SEGMENT_BYTES + len(found)] = found
        for batch in pieces(batches):
            source, keys, lines = [], [], []
            for row, raw in enumerate(binaries(batch.column(3))):
                places: dict[bytes, list[int]] = {}
                for number, line in enumerate(raw.split(b"\n")):
                    places.setdefault(line_key(line), []).append(number)
                places.pop(b"", None)
                source += [row] * len(places)
                keys += places.keys()
                lines += places.values()
            if not keys:
                continue
            hit = np.flatnonzero(_holds(twice, _probes(keys, bits))).tolist()
            at = pa.array([source[i] for i in hit], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(at) for i in range(3)), pa.array([keys[i] for i in hit], pa.binary()),
                 pa.array([lines[i] for i in hit], pa.list_(pa.int32()))],
                names=[*KEY, "doc_id", "key", "lines"])

    keyed = docs.select(*row_key(), "doc_id", text_bytes().alias("raw"))
    schema = keyed.drop("raw").schema.add("key", "binary").add("lines", T.ArrayType(T.IntegerType()))
    return keyed.mapInArrow(ask, schema)


def dropped_lines(spark: SparkSession, docs: DataFrame, min_documents: int = MIN_DOCUMENTS,
                  keep_first: bool = False, bits: int | None = None) -> DataFrame:
    """Line numbers that go, per document that loses any."""
    found = keep(spark, suspects(spark, docs, bits), "suspects")
    place = F.struct("doc_id", *KEY, F.array_min("lines").alias("line"))
    counted = found.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    # written first: a join of two read tables is one whose hot keys Spark splits
    frequent = keep(spark, counted.where(F.col("n") >= min_documents).select("key", "first"), "frequent")
    hits = found.join(frequent, "key")
    lines = F.col("lines")
    if keep_first:
        is_first = (F.col("_k1") == F.col("first._k1")) & (F.col("_k2") == F.col("first._k2"))
        lines = F.when(is_first, F.filter("lines", lambda x: x != F.col("first.line"))).otherwise(lines)
    return hits.groupBy(*KEY).agg(
        F.array_distinct(F.flatten(F.collect_list(lines))).alias("gone"))


def _parted(spark: SparkSession, keyed: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that may lose a line, which have to meet their line numbers, and those that surely do not.

    One bit for each hash of a document that does, in a bitmap of 16 bits for each of them, at
    most ``MAX_BITS``; a bit that others share only sends a document the longer way.
    """
    bits = 1 << min(MAX_BITS.bit_length() - 1, max(15, (16 * gone.count()).bit_length()))
    place = F.pmod("_k1", F.lit(bits)) + 1  # the functions count from 1
    parts = gone.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    shared = spark.sparkContext.broadcast({r.bucket: bytes(r.bits) for r in parts.collect()})  # bits / 8 bytes at most

    def held(wanted: bool):
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(bits, bool)
            for bucket, part in shared.value.items():  # buckets count from 1, and hold 2**15 bits each
                found[(bucket - 1) << 15:bucket << 15] = np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little")
            for batch in batches:
                hit = found[batch.column(0).to_numpy() % bits] == wanted
                yield batch.filter(pa.array(hit))

        return keyed.mapInArrow(look, keyed.schema)

    return held(True), held(False)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_documents: int = MIN_DOCUMENTS,
                keep_first: bool = False, bits: int | None = None) -> DataFrame:
    """The documents with the lines that stay in ``text``, and the columns ``ADDED``, which replace ones of that name."""
    gone = keep(spark, dropped_lines(spark, docs, min_documents, keep_first, bits), "gone")
    inputs = own_columns(docs, ADDED)
    keyed = docs.select(*row_key(), F.struct(*inputs).alias("_row"))
    maybe, untouched = _parted(spark, keyed, gone)
    joined = maybe.join(gone, KEY, "left").select("_row", "gone").unionByName(
        untouched.select("_row", F.lit(None).cast("array<int>").alias("gone")))
    names = [f.name for f in keyed.schema["_row"].dataType.fields]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in pieces(batches):
            columns = batch.column(0).flatten()
            texts, lengths, counts = [], [], []
            for raw, lines in zip(binaries(columns[at]), batch.column(1).to_pylist()):
                split = (raw or b"").split(b"\n")
                drop = set(lines or ())
                texts.append(raw if not drop else b"\n".join(x for i, x in enumerate(split) if i not in drop))
                lengths.append(len(split))
                counts.append(len(drop))
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lengths, pa.int64()), pa.array(counts, pa.int64())], names=[*names, *ADDED])

    schema = docs.select(*inputs).withColumns({name: F.lit(0).cast("long") for name in ADDED}).schema
    return joined.mapInArrow(rewrite, schema)
