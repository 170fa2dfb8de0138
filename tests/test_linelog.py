"""Text files read by offsets, in batch and as a stream."""

import json
import random

import pytest

from shoplens.sinks import streams as sinks
from shoplens.sources import linelog
from shoplens.sources.lines import lines_from


def values(df):
    return sorted(r.value for r in df.collect())


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "topic"
    path.mkdir()
    (path / "a.txt").write_bytes(b"a1\na2\r\n\na4 \xc3\xa9\n")
    (path / "b.txt").write_bytes(b"b1\nb2\nhalf a li")
    (path / "_SUCCESS").write_bytes(b"x\n")
    (path / "empty.txt").write_bytes(b"")
    return path


def test_offsets_are_the_ends_of_whole_lines(folder):
    assert linelog.ends(str(folder)) == linelog.ends(f"file://{folder}") == {"a.txt": 14, "b.txt": 6, "empty.txt": 0}
    assert linelog.ends(str(folder / "none")) == {}


def test_batch_reads_between_offsets(spark, folder):
    assert values(lines_from(spark, str(folder))) == ["", "a1", "a2", "a4 é", "b1", "b2"]
    assert values(lines_from(spark, str(folder), json.dumps({"a.txt": 3, "b.txt": 6}))) == ["", "a2", "a4 é"]
    end = json.dumps({"a.txt": 3, "b.txt": 3})
    assert values(lines_from(spark, str(folder), endingOffsets=end)) == ["a1", "b1"]
    with pytest.raises(Exception, match="a batch read needs a start"):
        lines_from(spark, str(folder), "latest").collect()


def test_ranges_split_no_line(spark, tmp_path):
    rng = random.Random(2)
    lines = ["x" * rng.choice([0, 1, 5, 40]) + str(n) for n in range(300)]
    (tmp_path / "big.txt").write_text("".join(f"{x}\n" for x in lines))
    for size in (1, 2, 7, 64, 1000):
        df = spark.read.format("linelog").option("rangeBytes", size).load(str(tmp_path)) if size == 64 else None
        if df is not None:
            assert values(df) == sorted(lines)
            assert df.rdd.getNumPartitions() > 10
        parts = linelog.ranges({}, linelog.ends(str(tmp_path)), size)
        read = [v for p in parts for b in linelog.read_range(str(tmp_path), p, rows=3) for v in b.column(2).to_pylist()]
        assert read == lines


def test_stream_starts_at_an_offset_and_is_resumed(spark, folder, tmp_path):
    start = json.dumps(linelog.ends(str(folder)))

    def run(offsets, name):
        stream = lines_from(spark, str(folder), offsets, streaming=True)
        sinks.append_sink(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint", drain=True).awaitTermination()
        return values(spark.read.parquet(f"{tmp_path}/{name}"))

    with open(folder / "b.txt", "ab") as file:
        file.write(b"ne\nb4\nrest")
    (folder / "c.txt").write_text("c1\n")
    assert run(start, "explicit") == ["b4", "c1", "half a line"]
    assert len(run("earliest", "all")) == 9
    with open(folder / "b.txt", "ab") as file:
        file.write(b" of it\n")
    assert run("earliest", "explicit") == ["b4", "c1", "half a line", "rest of it"]  # the checkpoint counts
