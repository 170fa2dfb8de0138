import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoplens.llm import kneserney
from tests.llm.common import awkward, documents, empty

END, OPEN = object(), object()


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


class Brute:
    """The same model from dictionaries, straight from the definition."""

    def __init__(self, texts, order):
        self.order, self.words = order, Counter(t for text in texts for t in tokens_of(text))
        self.grams = {order: Counter()}
        for text in texts:
            line = [OPEN] * (order - 1) + tokens_of(text)
            for i in range(order - 1, len(line)):
                self.grams[order][tuple(line[i - order + 1:i + 1])] += 1
        for k in range(order - 1, 0, -1):
            before, raw = defaultdict(set), Counter()
            for gram, n in self.grams[k + 1].items():
                before[gram[1:]].add(gram[0])
                raw[gram[1:]] += n
            self.grams[k] = {g: raw[g] if g[0] is OPEN else len(b) for g, b in before.items()}
        self.d, self.followers = {}, {}
        for k, grams in self.grams.items():
            n = Counter(grams.values())
            self.d[k] = kneserney.discounts([n[1], n[2], n[3], n[4]])
            self.followers[k] = defaultdict(list)
            for gram, c in grams.items():
                self.followers[k][gram[:-1]].append(c)

    def p(self, gram):
        if not gram:
            return 1 / (len(self.words) + 1)
        k, counts = len(gram), self.followers[len(gram)].get(gram[:-1])
        lower = self.p(gram[1:])
        if not counts:
            return lower
        d = self.d[k]
        c = self.grams[k].get(gram, 0)
        spread = sum(d[min(x, 3) - 1] for x in counts)
        return (max(c - (d[min(c, 3) - 1] if c else 0), 0) + spread * lower) / sum(counts)

    def score(self, text):
        line = [OPEN] * (self.order - 1) + tokens_of(text)
        return sum(math.log10(self.p(tuple(line[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(line)))

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens_of(text))


def corpus(seed, n=80):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "é", "The", "the", "</s>", "a b"]
    texts = []
    for _ in range(n):
        line = [rng.choice(words)]
        for _ in range(rng.randrange(0, 60)):
            line.append(words[(words.index(line[-1]) * 7 + min(int(rng.expovariate(1)), 20)) % len(words)])
        texts.append(rng.choice([" ", "\n", " \t"]).join(line) + (f" only{rng.random()}" if rng.random() < 0.3 else ""))
    return texts


def compare(rows, got, order):
    train = [t for i, t in rows if not held(i)]
    model = Brute(train, order)
    assert len(got) == len(rows)
    wanted = sorted((i is None, i or 0, len(tokens_of(t)), sum(x in model.words for x in tokens_of(t)), t or "") for i, t in rows)
    for (_, i, n, known, text), r in zip(wanted, sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known))):
        assert (r.doc_id or 0, r.n_tokens, r.n_known) == (i, n, known)
        assert r.held_out == held(r.doc_id) and r.train_tokens == sum(model.words.values())
        assert r.base_score == pytest.approx(model.base(text), rel=1e-9)
        assert r.score == pytest.approx(model.score(text), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    texts = [*corpus(order), None, "", " \n ", "word " * 20_000]
    rows = list(enumerate(texts))
    got = kneserney.held_out_scores(spark, documents(spark, texts), order, range_bytes=1 << 12).collect()
    compare(rows, got, order)


def test_probabilities_of_a_context_add_up_to_one():
    model = Brute(corpus(9), 3)
    for gram in random.Random(1).sample(sorted(model.grams[3], key=str), 20):
        total = sum(model.p((*gram[:-1], w)) for w in model.words) + model.p((*gram[:-1], "never seen"))
        assert total == pytest.approx(1)


def test_the_model_beats_single_words_on_held_out_texts(spark):
    rows = kneserney.held_out_scores(spark, documents(spark, corpus(5, 300))).where("held_out").collect()
    assert len(rows) > 30
    assert sum(r.score for r in rows) > 0.85 * sum(r.base_score for r in rows)


def test_awkward_tables(spark):
    docs = awkward(spark)
    got = kneserney.held_out_scores(spark, docs).collect()
    compare([(r.doc_id, r.text) for r in docs.collect()], got, 2)
    assert kneserney.held_out_scores(spark, empty(spark)).collect() == []
    alone = next(i for i in range(50) if held(i))
    row, = kneserney.held_out_scores(spark, documents(spark, ["never trained"], [alone])).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == row.score == 0


def test_word_hashes():
    texts = ["", "a B\tb", " \n", "É é x" * 3, "b"]
    h, n = kneserney.word_hashes([t.encode() for t in texts])
    assert n.tolist() == [len(tokens_of(t)) for t in texts]
    flat = [t for text in texts for t in tokens_of(text)]
    names = {}
    for word, x in zip(flat, h.tolist()):
        assert names.setdefault(word, x) == x
    assert len(set(names.values())) == len(names)


def test_files_are_found_by_hash(spark, tmp_path):
    h = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 1000, np.uint64))
    counts = [np.arange(1000, dtype=np.uint64), np.full(1000, 70_000, np.uint64)]
    for number in (0, 1):
        part = (h >> np.uint64(63)).astype(int) == number
        if part.any():
            kneserney.write_table(str(tmp_path), f"2-1-{number}", h[part], [x[part] for x in counts])
    tables = kneserney.Tables(f"file://{tmp_path}", 1)
    asked = np.sort(np.concatenate([h[::7], h[::11] + np.uint64(1), np.array([2 ** 64 - 5], np.uint64)]))
    place, (one, two) = tables.find(2, 1, asked, 2)
    for x, p, a, b in zip(asked.tolist(), place, one, two):
        assert (p >= 0) == (x in set(h.tolist())) and (b == 70_000) == (p >= 0)
        assert p < 0 or h[a] == x
