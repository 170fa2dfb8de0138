import gzip
import hashlib
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from shoplens.llm import warc

PAGES = "page_id long, url string, html string, digest string, first int, key string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "k") for r in rows], PAGES)


def brute(rows):
    first = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= warc.MIN_REVISIT:
            first[payload] = min(page, first.get(payload, page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        lead = first.get(payload)
        refers = lead if page is not None and lead is not None and lead != page else None
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_round_trip_and_revisits(spark):
    rng = random.Random(1)
    bodies = ["", None, "short", "é" * 50, "x" * 99, "x" * 100, "WARC/1.0\r\n\r\n\r\n" * 20, "a\r\nb\n" * 50, "\0" * 120, "long " * 40_000]
    rows = [(i, f"http://www.h{rng.randrange(3)}.org:80/p{rng.randrange(9)}?q#f", rng.choice(bodies)) for i in range(300)]
    rows += [(None, None, "y" * 200), (None, "u", "y" * 200), (7, "http://x\r\nEvil: 1", "y" * 200), (7, "http://b", "y" * 200), (-3, "", "x" * 100)]
    rng.shuffle(rows)
    found = warc.capture_histories(spark, pages(spark, rows).repartition(5)).collect()
    got = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=str)
    assert got == brute(rows)


def test_histories_are_in_global_order(spark):
    rng = random.Random(2)
    hosts = ["hot.com"] * 6 + ["b.a.net", "c.org"]
    rows = [(i, f"https://{rng.choice(hosts)}/{rng.randrange(4)}", f"body {i}") for i in rng.sample(range(1000), 400)]
    archives = warc.write_archives(spark, pages(spark, rows).repartition(3), warc.scratch_dir(spark, "t"), file_bytes=3000)
    index = warc.read_archives(archives).cache()  # runs are sorted by themselves
    per_run = {}
    for r in index.collect():
        per_run.setdefault(r.run, []).append((r.position, (r.key, r.captured, r.page_id)))
    assert len(per_run) > 20
    for own in per_run.values():
        keys = [k for _, k in sorted(own)]
        assert keys == sorted(keys)
    merged = warc.merge_runs(index, rows_per_range=60)
    assert merged.rdd.getNumPartitions() > 3
    order = [(r.key, r.captured, r.page_id) for r in merged.collect()]
    assert order == sorted(order) and len(order) == 400


def test_url_keys(spark):
    urls = {"http://www.Example.COM:8080/A?b=C#d": "com,example)/A?b=C", "https://u:p@x.y.z": "z,y,x)/", "/path": ")/path",
            "": ")/", "//h/": "h)/", "ftp://www2.a.b/?": "b,a)/?"}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.url_key(F.col("u")).alias("k"))
    assert {r.u: r.k for r in rows.collect()} == urls


def test_loser_tree_sorts():
    rng = random.Random(3)
    for _ in range(300):
        runs = [sorted(rng.randrange(9) for _ in range(rng.randrange(8))) for _ in range(rng.randrange(9))]
        merged = [(runs[r][i], r, i) for r, i in warc.LoserTree(runs)]
        assert merged == sorted(merged) and len(merged) == sum(map(len, runs))


def test_files_are_bounded_by_bytes_and_offsets_open_records(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}", rng.randbytes(rng.choice([10, 3000])).hex()) for i in range(120)]
    archives = warc.write_archives(spark, pages(spark, rows).coalesce(2), warc.scratch_dir(spark, "t"), file_bytes=20_000)
    sizes = {r.path: r.size for r in archives.collect()}
    assert len(sizes) > 4 and max(sizes.values()) < 30_000
    bodies = {page: html for page, _, html in rows}
    for r in warc.read_archives(archives).collect():
        with open(r.run.removeprefix("file://"), "rb") as file:
            assert os.path.getsize(file.name) == sizes[r.run]
            file.seek(r.record_offset)
            _, headers, payload = next(warc._records(file))
        assert payload.decode() == bodies[r.page_id] and headers["WARC-Target-URI"] == f"http://h/{r.page_id}"


def test_records_are_read_in_pieces():
    records = [b"WARC/1.0\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"x" * n) for n in (0, 1, 5000, 3)]
    packed = [gzip.compress(r) for r in records]
    for chunk in (1, 7, 1 << 20):
        found = list(warc._records(io.BytesIO(b"".join(packed)), chunk))
        assert [len(p) for _, _, p in found] == [0, 1, 5000, 3]
        assert [at for at, _, _ in found] == [sum(map(len, packed[:k])) for k in range(4)]


def test_damage_is_noticed():
    good = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [p for _, _, p in warc._records(io.BytesIO(gzip.compress(good) * 2))] == [b"abc"] * 2
    for bad in (b"WARC/1.0\r\nContent-Length: 4\r\n\r\nabc\r\n\r\n", b"junk" + good, good * 2):
        with pytest.raises(ValueError):
            list(warc._records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(warc._records(io.BytesIO(gzip.compress(good)[:-3])))


def test_no_pages(spark):
    assert warc.capture_histories(spark, pages(spark, [])).count() == 0
