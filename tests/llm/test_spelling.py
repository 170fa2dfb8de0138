import random
import re
import zlib
from collections import Counter

import numpy as np

from shoplens.llm import spelling
from tests.llm.common import awkward, documents, empty


def brute_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 7:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    out = {}
    for word, n in counts.items():
        near = [x for x in counts if one_edit(word, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[word] = (best if best and counts[best] >= 10 * n else None, n, len(near))
    rows = set()
    for word, (form, n, n_near) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.add((word, form, root, n, n_near, counts[form] if form else None))
    return rows


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    letters = "abcdeÀéÿ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 12))) for _ in range(40)]
    texts = []
    for _ in range(n_docs):
        words = []
        for _ in range(rng.randrange(10, 120)):
            word = stems[min(int(rng.expovariate(0.2)), 39)]
            if rng.random() < 0.2:  # any edit, also into other lengths
                i, kind = rng.randrange(len(word)), rng.randrange(4)
                c = rng.choice(letters)
                word = [word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:],
                        word[:i] + word[i + 1:] + word[i]][kind]
            words.append(word.upper() if rng.random() < 0.1 else word)
        texts.append(rng.choice([" ", "-", "1", "\n"]).join(words))
    return texts


def found(frame):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_variants_equal_brute_force(spark):
    texts = [*corpus(4), None, "", "x" * 50_000, "x" * 50_000, "x" * 49_999 + "y", "x" * 50_001, "x" * 49_999 + "y"]
    rows = list(enumerate(texts))
    wanted = brute_variants(brute_counts(rows))
    docs = documents(spark, texts)
    got = found(spelling.variants(spark, docs))
    assert got == wanted and any(r[1] for r in wanted) and any(r[2] not in (r[0], r[1]) for r in wanted)
    # small cells and a small sample: most pairs lie in different cells, some lengths have no tree
    assert found(spelling.variants(spark, docs, sample=32, cell_words=8)) == wanted


def test_boxes_lose_no_near_word():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcé") for _ in range(8)) for _ in range(3000)})
    longer = sorted({w[:i] + rng.choice("abcé") + w[i:] for w in words[:300] for i in (0, 3, 8)})
    pairs = set()
    for q, p, role in spelling.near_in_cell(longer, [], words):
        asked = longer if role == spelling.POINT else words
        pairs |= {frozenset((asked[x], longer[y])) for x, y in zip(q, p)}
    everything = {frozenset((a, b)) for b in longer for a in [*words, *longer] if one_edit(a, b)}
    assert pairs == everything


def test_one_letter_more():
    words = ["abcdefg", "aaaaaaa", "abababa"]
    for a in words:
        for b in {w[:i] + c + w[i:] for w in words for i in range(8) for c in "ab"}:
            got = spelling.inserted(*(np.frombuffer(x.encode(), np.uint8)[None, :] for x in (a, b)))
            assert got[0] == one_edit(a, b)


def test_awkward_tables(spark):
    docs = awkward(spark)
    assert found(spelling.variants(spark, docs)) == brute_variants(brute_counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert spelling.variants(spark, empty(spark)).collect() == []
    hot = documents(spark, ["abcdefgh " * 5000, "abcdefgi abcdefgi", None, "abcdefgh"] * 3)
    assert {r[:3] for r in found(spelling.variants(spark, hot))} >= {("abcdefgi", "abcdefgh", "abcdefgh")}


def test_chains_are_followed_to_the_end(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)], "word string, form string")
    assert {r.root for r in spelling.roots(spark, forms).collect()} == {"w13"}
