import random
from collections import Counter

import numpy as np

from shoplens.llm import bagminhash as bag
from shoplens.llm import minhash
from tests.llm.common import awkward, documents, empty


def shingled(text):
    words = bag.normal((text or "").encode()).split()
    if not words:
        return Counter()
    n = min(5, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def test_shingles_equal_brute_force():
    texts = ["", "a b", "A, b!", "a b c d e f", "...", "a a a a a a a", "é è\nx y z É è x y z", "w" * 5000]
    text, _, count = bag.shingles([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert sorted(count[text == i].tolist()) == sorted(shingled(t).values())
    for alone in (b"a", b"a b", b"a b c d"):
        assert [x.tolist() for x in bag.shingles([alone])[::2]] == [[0], [1]]
    text, element, _ = bag.shingles([b"a b c d e", b"x A  b.c d E y", b"a b c", b"a b c d"])
    assert len(set(element[text == 0]) & set(element[text == 1])) == 1
    assert not set(element[text == 2]) & set(element[text == 3])


def test_signatures_are_unbiased_for_weights():
    rng, differences = random.Random(5), []
    for trial in range(120):
        words = [f"t{trial}w{rng.randrange(60)}" for _ in range(150)]
        a, b = " ".join(words), " ".join(words[:110] + words[:rng.randrange(60)])
        text, element, count = bag.shingles([a.encode(), b.encode()])
        signature = bag.signatures(2, text, element, count)
        differences.append((signature[0] == signature[1]).mean() - similarity(shingled(a), shingled(b)))
    assert abs(np.mean(differences)) < 0.015
    assert np.std(differences) < 0.07
    heavy = [(np.array([9], np.uint64), np.array([w])) for w in (30, 40)]
    agree = []
    for seed in range(300):
        text, element = np.array([0, 1]), np.array([seed + 1, seed + 1], np.uint64)
        signature = bag.signatures(2, text, element, np.array([30, 40]))
        agree.append((signature[0] == signature[1]).mean())
    assert abs(np.mean(agree) - 0.75) < 0.02 and heavy


def brute_classes(rows):
    parent = {i: i for i in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    grams = [shingled(text) for _, text in rows]
    for i in range(len(rows)):
        for j in range(i):
            if grams[i] and 10 * similarity(grams[i], grams[j]) >= 8 - 1e-9:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted(sorted(g) for g in groups.values())


def corpus(rng):
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for base in range(12):  # groups of near copies, some of them chains
        words = [f"b{base}w{rng.randrange(500)}" for _ in range(120)]
        for _ in range(rng.randrange(1, 7)):
            words = list(words)
            words[rng.randrange(len(words))] = f"n{rng.random()}"
            texts.append(" ".join(words))
    for i in range(40):  # a passage that many texts share, too little for a link
        own = [f"o{i}w{j}" for j in range(rng.randrange(20, 60))]
        texts.append(" ".join(passage + own))
    for _ in range(4):  # the passage and little else: links among these
        texts.append(" ".join(passage + [f"z{rng.random()}"]))
    texts += texts[:5] + [t.upper() for t in texts[5:8]]
    rng.shuffle(texts)
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus(random.Random(11))
    found = minhash.duplicate_classes(spark, documents(spark, texts)).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(list(enumerate(texts)))
    assert all(key == min(group) for key, group in groups.items())


def test_the_exact_index_finds_what_leaders_leave(spark):
    texts = corpus(random.Random(12))
    rows = spark.createDataFrame([(i.to_bytes(4, "big"), t) for i, t in enumerate(texts)], "node binary, text string")
    opened = rows.selectExpr("node", "node AS class")
    pairs = {(r.a, r.b) for r in minhash.verified(minhash._remaining(spark, opened, rows), rows).collect()}
    grams = [shingled(t) for t in texts]
    alike = {(i.to_bytes(4, "big"), j.to_bytes(4, "big")) for j in range(len(texts)) for i in range(j)
             if 10 * similarity(grams[i], grams[j]) >= 8 - 1e-9}
    assert pairs == alike


def test_components_of_a_long_chain(spark):
    n = 40
    names = list(range(n))
    random.Random(3).shuffle(names)
    links = [(names[i].to_bytes(2, "big"), names[i + 1].to_bytes(2, "big")) for i in range(n - 1)]
    found = minhash.components(spark, spark.createDataFrame(links, "a binary, b binary")).collect()
    assert len(found) == n and {bytes(r["class"]) for r in found} == {b"\0\0"}


def test_one_document_of_each_class_stays(spark):
    docs = awkward(spark)
    kept = minhash.distinct_documents(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or -1), (r.text or "")[:20]) for r in kept.collect()) == [
        (-1, "x " * 10), (1, ""), (3, "one"), (4, "same line\nother"), (6, "é\n\n\t \nÉ")]
    classes = {(r.doc_id, r.class_id) for r in minhash.duplicate_classes(spark, docs).collect()}
    assert {(1, 1), (2, 1), (7, 1), (3, 3), (8, 3), (4, 4), (None, 1), (None, None)} <= classes
    assert minhash.duplicate_classes(spark, empty(spark)).count() == 0
    assert minhash.distinct_documents(spark, empty(spark)).count() == 0
