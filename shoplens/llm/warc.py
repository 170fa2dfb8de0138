"""Web archives: records written, read back, and their sorted index runs merged.

1. Every page becomes a record of an archive.  Of pages with equal payloads of
   ``MIN_REVISIT`` bytes or more the smallest id is written in full, the others are
   revisits of it, without payload.  The digests' groups are counted before the
   shuffle; only digests that occur twice are joined back.
2. Each task writes its records in the order of URL key and time, so the index of each
   archive file is a locally sorted run.  Every record is a gzip member of its own, so the
   offset in the index is where a reader can begin.  A file ends with the first record
   that takes it beyond ``FILE_BYTES``.  Files are written under another name and renamed,
   and listed in a table that Spark commits; what a failed task left is in no list.
3. The listed archives are read as streams, a record at a time; payloads are hashed again
   and must match the headers.  The index runs are kept as a table in the shared folder.
4. Runs are cut at the same quantiles of (URL key, time, page), and each range merges its
   parts of all runs with a loser tree.  A hot host or URL is cut like any other.

Defined results: a null page is an empty payload; a null page id is always a response
and comes first among equals; rows that repeat the smallest id are responses too; a
null URL is empty; line ends in URLs are percent-encoded; no rows give no records.  A
page of any length is one record; a task holds one record at a time.  Pages with equal
keys and times go by id.  Further columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import keep
from shoplens.plans.scratch import scratch_dir

MIN_REVISIT = 100  # bytes
FILE_BYTES = 64 << 20  # compressed, of an archive file
RANGE_ROWS = 20_000  # of an index range that one task merges
_END = "\r\n\r\n"
_FIRST_DAY = 1704067200  # capture times of pages without one count seconds from here, by id


def url_key(url: Column) -> Column:
    """Host labels in reverse, then path and query: ``com,example)/a?b=c``."""
    front = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, front, 1)), r"^www[0-9]*\.", "")
    rest = F.regexp_replace(F.regexp_replace(url, front, ""), "#.*$", "")
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def with_types(spark: SparkSession, pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """page_id, url, key, second, payload, digest, bytes, refers_to (null for a response)."""
    if captured is None:
        captured = F.lit(_FIRST_DAY) + F.coalesce("page_id", F.lit(0))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        "page_id", url.alias("url"), url_key(url).alias("key"), captured.cast("long").alias("second"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    groups = rows.where((F.col("bytes") >= MIN_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    repeated = keep(spark, groups.where("first <> last").select("digest", "first"), "repeated")
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return rows.join(repeated, "digest", "left").withColumn("refers_to", refers).drop("first")


def _record() -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    revisit = F.col("refers_to").isNotNull()
    when = F.date_format(F.timestamp_seconds("second"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    size = F.col("bytes").cast("string")
    return F.concat(
        F.lit("WARC/1.0"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        line("WARC-Target-URI", F.col("url")), line("WARC-Date", when),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", size),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))))
        .otherwise(""),
        line("Content-Length", F.when(revisit, "0").otherwise(size)), F.lit(_END),
        F.when(revisit, "").otherwise(F.col("payload")))


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri("file://" + folder[len("file:"):] if folder.startswith("file:/") and "://" not in folder else folder)


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, captured: Column | None = None,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive files, each in the order of URL key, time and page -> their paths and sizes."""
    rows = with_types(spark, pages, captured).sortWithinPartitions("key", "second", "page_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _store(folder)
        files.create_dir(path, recursive=True)
        out, size, name = None, 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            files.move(f"{path}/.{name}", f"{path}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size])], names=["path", "size"])

        for batch in batches:
            for record in batch.column(0):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{path}/.{name}", compression=None)
                packed = _member(record.as_buffer().to_pybytes())
                out.write(packed)
                size += len(packed)
                if size > file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    records = rows.select(F.concat(_record(), F.lit(_END)).cast("binary").alias("record"))
    return keep(spark, records.mapInArrow(write, "path string, size long"), "archives")


def _records(source: BinaryIO, chunk: int = 1 << 20) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset of the member, headers and payload of each record of a file, one member in memory at a time."""
    offset, rest = 0, b""
    while rest or (rest := source.read(chunk)):
        unpacker, parts, size = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not rest and not (rest := source.read(chunk)):
                raise ValueError(f"the record at {offset} is cut off")
            parts.append(unpacker.decompress(rest))
            size += len(rest) - len(unpacker.unused_data)
            rest = unpacker.unused_data
        head, found, body = b"".join(parts).partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8").split("\r\n")
        if version != "WARC/1.0" or not found:
            raise ValueError(f"no record begins at {offset}")
        headers = dict(line.partition(": ")[::2] for line in lines)
        length = int(headers["Content-Length"])
        if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
            raise ValueError(f"the record at {offset} has another length")
        yield offset, headers, body[:length]
        offset += size


def _page_of(name: str | None) -> int | None:
    number = (name or "none").removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


_RUNS = ("run string, position long, record_offset long, page_id long, url string, captured string, record_type string, "
         "refers_to long, payload_bytes long, payload_digest string")


def read_archives(archives: DataFrame) -> DataFrame:
    """The index of the archive files of a list: a sorted run per file, with the place of each record in it."""
    names = [field.split()[0] for field in _RUNS.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _ARROW)], names=names)

        for batch in batches:
            for run in batch.column(0).to_pylist():
                files, path = _store(run)
                rows = []
                with files.open_input_stream(path, compression=None) as source:
                    for position, (offset, headers, payload) in enumerate(_records(source)):
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind, size = headers["WARC-Type"], int(headers["X-Payload-Length"])
                        if kind == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"the payload at {offset} does not match its digest")
                        rows.append((run, position, offset, _page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"],
                                     headers["WARC-Date"], kind, _page_of(headers.get("WARC-Refers-To")), size, digest))
                        if len(rows) == 5000:
                            yield packed(rows)
                            rows = []
                if rows:
                    yield packed(rows)

    # a file is a task's worth of work, its line in the list is not
    files = archives.select("path").repartition(max(1, archives.count()), "path")
    return files.mapInArrow(parse, _RUNS).withColumn("key", url_key(F.col("url")))


_ARROW = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
          pa.int64(), pa.int64(), pa.string()]


class LoserTree:
    """The order of the items of sorted runs; each inner node holds the run that lost there."""

    def __init__(self, runs: list[list]) -> None:
        self._runs, self._next = runs, [0] * len(runs)
        self._losers = [-1] * len(runs)
        for run in range(len(runs)):
            self._play(run)

    def _head(self, run: int) -> tuple:
        at = self._next[run]
        return (1,) if at >= len(self._runs[run]) else (0, self._runs[run][at], run)

    def _play(self, run: int) -> None:
        node = (run + len(self._runs)) // 2
        while node:
            other = self._losers[node]
            if other < 0:  # the first to come waits for its opponent
                self._losers[node] = run
                return
            if self._head(other) < self._head(run):
                self._losers[node], run = run, other
            node //= 2
        self._losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, number of the item in it), in order."""
        while self._runs:
            run = self._losers[0]
            at = self._next[run]
            if at >= len(self._runs[run]):
                return
            yield run, at
            self._next[run] = at + 1
            self._play(run)


def merge_runs(runs: DataFrame, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """All index rows in the order of URL key, time and page: over the partitions, and within each."""
    ranges = max(1, -(-runs.count() // rows_per_range))
    names, schema = runs.columns, runs.schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()  # rows of one range
        column = {name: table.column(name).to_pylist() for name in ("run", "key", "captured", "page_id")}
        starts = [i for i, run in enumerate(column["run"]) if not i or run != column["run"][i - 1]]
        order = [(k, c, p is not None, p or 0) for k, c, p in zip(column["key"], column["captured"], column["page_id"])]
        sorted_runs = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
        at = pa.array([starts[run] + nth for run, nth in LoserTree(sorted_runs)], pa.int64())
        yield from table.take(at).to_batches()

    ranged = runs.repartitionByRange(ranges, "key", "captured", "page_id", "run", "position")
    return ranged.sortWithinPartitions("run", "position").select(*names).mapInArrow(merge, schema)


def capture_histories(spark: SparkSession, pages: DataFrame, folder: str | None = None,
                      captured: Column | None = None) -> DataFrame:
    """Writes the archives, reads them and merges their indexes."""
    folder = folder or scratch_dir(spark, "warc")
    archives = write_archives(spark, pages, folder, captured)
    return merge_runs(keep(spark, read_archives(archives), "runs"))
