import time
import hashlib
import random
import re

import pytest

from shoplens.llm import decontam
from tests.llm.common import awkward, documents, empty


def words(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(texts, items):
    out = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for item, benchmark in items:
            b = words(benchmark)
            n = min(10, len(b))
            windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(own) - n + 1 if b else 0):
                if tuple(own[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        found.add(item)
        listed = ",".join(sorted(map(str, found)))
        out.append((len(own), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6 if seed == 3 else 400)] + ["É", "é", "Tr-x", "ÿ"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([0, 1 if seed == 1 else 12, 4, 9, 10, 11, 25, 40, 14])]
    items += [(6, items[7][1]), (None, items[8][1]), (20, None)]
    texts = []
    for _ in range(60):
        own = rng.choices(vocabulary, k=rng.randrange(0, 40))
        if rng.random() < 0.6:
            part = words(rng.choice(items)[1])
            cut = rng.randrange(0, max(1, len(part) - 9))
            own[rng.randrange(0, len(own) + 1):0] = part[cut:cut + rng.choice([8, 9, 10, 12, 30])]
        texts.append(rng.choice([" ", ", ", "\n"]).join(own).title())
    found = decontam.report(spark, documents(spark, texts), benchmark(spark, items)).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}
    assert [got[i] for i in range(len(texts))] == brute(texts, items)


def test_awkward_rows(spark):
    docs, items = awkward(spark), [(1, "x x x"), (2, "same line other")]
    found = decontam.report(spark, docs, benchmark(spark, items)).collect()
    assert len(found) == docs.count()
    hit = sorted((r.doc_id or -1, r.n_hit) for r in found if r.contaminated)
    assert hit == [(-1, 60_000), (4, 3), (4, 3)]
    clean = decontam.clean(spark, docs, benchmark(spark, items))
    assert clean.columns == docs.columns and clean.count() == docs.count() - 3
    nothing = benchmark(spark, [])
    assert decontam.clean(spark, docs, nothing).count() == docs.count()
    assert decontam.report(spark, empty(spark), benchmark(spark, items)).count() == 0


def test_a_shared_span_shares_a_fingerprint(spark):
    rng = random.Random(8)
    rows = []
    for i in range(80):
        span = [f"s{rng.randrange(50)}" for _ in range(10)]
        side = [" ".join([f"{k}{rng.random()}" for _ in range(rng.randrange(30))] + span + [f"{k}{rng.random()}"]) for k in "ab"]
        rows.append((i, *side))
    table = spark.createDataFrame(rows, "i int, a string, b string")
    kept = decontam.fingerprints("ws", [], 10, 5)
    for c in "ab":
        table = table.selectExpr("*", f"flatten(transform(array(split({c}, ' ')), ws -> {kept})) AS f{c}")
    assert table.where("NOT arrays_overlap(fa, fb)").count() == 0


def test_a_long_text_copied_whole(spark):
    words = [f"w{i}" for i in range(30_000)]
    docs = documents(spark, [" ".join(words), " ".join(words[::-1])])
    items = spark.createDataFrame([("a", " ".join(words[:15_000])), ("b", " ".join(words[15_000:]))], "item_id string, text string")
    begin = time.time()
    rows = {r.doc_id: (r.n_hit, r.n_items) for r in decontam.report(spark, docs, items).collect()}
    assert rows == {0: (30_000, 2), 1: (0, 0)}
    assert time.time() - begin < 60  # one look-up for each word among all its hashes takes minutes
