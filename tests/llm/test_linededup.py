import re
from collections import Counter

import pytest

from shoplens.llm import linededup
from tests.llm.common import awkward, documents, empty


def key(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m.group().lower(), line)


def brute(texts, least):
    lines = [(text or "").split("\n") for text in texts]
    count = Counter(k for own in lines for k in {key(line) for line in own})
    return ["\n".join(line for line in own if not key(line) or count[key(line)] < least) for own in lines]


@pytest.mark.parametrize("bits", [None, 1 << 20, 8 * linededup.SEGMENT_BYTES])
def test_equals_brute_force(spark, bits):
    texts = [f"Head {i % 7}\n  Shared LINE \nown {i}\n\nÉ{i % 3}\n" for i in range(60)] + ["shared line\nshared line"] * 5 + ["", None]
    docs = documents(spark, texts).repartition(7)
    found = {r.doc_id: r.text or "" for r in linededup.dedup_lines(spark, docs, bits=bits).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, 10)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(linededup, "_holds", lambda filter_, probes: (probes >= 0).all(1))
    texts = [f"a {i % 4}\nb {i}" for i in range(50)]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark, documents(spark, texts)).collect()}
    assert [found[i] for i in range(50)] == brute(texts, 10)


def test_first_occurrence_may_stay(spark):
    texts = ["x\ny", "y\nx", "x\nx"]
    kept = linededup.dedup_lines(spark, documents(spark, texts, [3, 1, 2]), 2, keep_first=True)
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "y\nx", 2: "", 3: ""}


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = linededup.dedup_lines(spark, docs, 2)
    assert out.columns == [*docs.columns, *linededup.ADDED]
    rows = sorted(((r.doc_id or -1), r.text or "", r._n_lines, r._n_dropped) for r in out.collect())
    assert len(rows) == docs.count()
    assert [r for r in rows if r[0] == 4] == [(4, "", 2, 2)] * 2
    assert [r[1:] for r in rows if r[0] in (3, 8)] == [("", 1, 1)] * 2
    assert [r[1:] for r in rows if r[0] == 6] == [("é\n\n\t \nÉ", 4, 0)]
    assert linededup.dedup_lines(spark, empty(spark)).count() == 0


def test_filter_size_follows_the_documents():
    assert linededup.filter_bits(0) == 1 << 20
    assert linededup.filter_bits(1 << 14) == 1 << 21
    assert linededup.filter_bits(10 ** 12) == linededup.MAX_BITS


def test_only_documents_that_may_lose_a_line_are_shuffled(spark):
    texts = [f"own {i}" for i in range(2000)] + [f"shared line\nother {i}" for i in range(30)]
    docs = documents(spark, texts)
    gone = linededup.keep(spark, linededup.dropped_lines(spark, docs), "gone")
    keyed = docs.select(*linededup.row_key(), "doc_id")
    maybe, untouched = linededup._parted(spark, keyed, gone)
    sent, passed = ({r.doc_id for r in part.collect()} for part in (maybe, untouched))
    assert sent | passed == set(range(2030)) and not sent & passed
    assert set(range(2000, 2030)) <= sent and len(sent) < 100
    got = {r.doc_id: (r.text, r._n_lines, r._n_dropped) for r in linededup.dedup_lines(spark, docs).collect()}
    assert got == {i: (t if i < 2000 else t.split("\n")[1], 1 if i < 2000 else 2, int(i >= 2000)) for i, t in enumerate(texts)}
