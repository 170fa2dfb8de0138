"""Text files as a log with offsets (S3): read from the start, the end, or where one says.

A folder of text files is a topic, a file one of its partitions, and the place of a line in
its file (in bytes) its offset.  Like a message log it can be read from ``earliest``,
``latest`` or from offsets by file, in batch up to ``endingOffsets`` as well; a stream goes
on from its checkpoint, and takes what is appended to files and files that are added.  A
line counts once its line end is there.  Files are cut into ranges of ``rangeBytes``, so a
large one is read by many tasks.

::

    spark.dataSource.register(LineLog)
    spark.read.format("linelog").option("startingOffsets", '{"part-0.txt": 1200}').load(folder)
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file STRING, position BIGINT, value STRING"
RANGE_BYTES = 64 << 20
_CHUNK = 1 << 20


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    plain = folder.startswith("file:/") and "://" not in folder
    return pafs.FileSystem.from_uri("file://" + folder[len("file:"):] if plain else folder)


def _after_last_line(files: pafs.FileSystem, path: str, size: int) -> int:
    """Where the last whole line of a file ends."""
    with files.open_input_file(path) as file:
        end = size
        while end:
            begin = max(0, end - _CHUNK)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


def ends(folder: str) -> dict[str, int]:
    """The offsets after the last whole line of every file of a folder; names like ``_x`` and ``.x`` are no data."""
    files, path = _store(folder)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    data = [f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
    return {f.base_name: _after_last_line(files, f.path, f.size) for f in sorted(data, key=lambda f: f.path)}


@dataclass
class Range(InputPartition):
    """Lines of a file that begin in [start, end); ``cut`` if a line may go on across ``start``."""

    file: str
    start: int
    end: int
    cut: bool


def ranges(start: dict[str, int], end: dict[str, int], size: int) -> list[Range]:
    found = []
    for name, last in end.items():
        first = start.get(name, 0)
        found += [Range(name, at, min(at + size, last), at > first) for at in range(first, last, size)]
    return found


def read_range(folder: str, part: Range, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    files, path = _store(folder)
    with files.open_input_file(f"{path}/{part.file}") as file:
        at = part.start
        if part.cut:  # a line that begins before belongs to the range before
            at -= 1
            file.seek(at)
            while chunk := file.read(_CHUNK):
                skip = chunk.find(b"\n")
                if skip >= 0:
                    at += skip + 1
                    break
                at += len(chunk)
        file.seek(at)
        rest, places, values = b"", [], []
        while at < part.end and (chunk := file.read(_CHUNK)):
            *whole, rest = (rest + chunk).split(b"\n")
            for line in whole:
                if at >= part.end:
                    break
                places.append(at)
                values.append(line.removesuffix(b"\r"))
                at += len(line) + 1
            while len(places) >= rows:
                yield _batch(part.file, places[:rows], values[:rows])
                del places[:rows], values[:rows]
        if places:
            yield _batch(part.file, places, values)


def _batch(file: str, places: list[int], values: list[bytes]) -> pa.RecordBatch:
    text = pa.array([v.decode("utf-8", "replace") for v in values], pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(places), pa.string()), pa.array(places, pa.int64()), text], names=["file", "position", "value"])


class _Reads:
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.size = int(options.get("rangeBytes", RANGE_BYTES))
        self.start = options.get("startingOffsets", "earliest")
        self.end = options.get("endingOffsets", "latest")

    def offsets(self, said: str) -> dict[str, int]:
        if said == "earliest":
            return {}
        return ends(self.folder) if said == "latest" else {k: int(v) for k, v in json.loads(said).items()}

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(self.folder, partition)


class BatchReader(_Reads, DataSourceReader):
    def partitions(self) -> list[Range]:
        if self.start == "latest":
            raise ValueError("a batch read needs a start: earliest, or offsets by file")
        return ranges(self.offsets(self.start), self.offsets(self.end), self.size)


class StreamReader(_Reads, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.offsets(self.start)

    def latestOffset(self) -> dict:
        return ends(self.folder)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(start, end, self.size)


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)
