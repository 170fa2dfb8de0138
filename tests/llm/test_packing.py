import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import packing
from shoplens.llm.tokens import encoder
from tests.llm.common import awkward, documents, empty


def test_ids_equal_those_of_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    alphabet = list("abcdeXYZ  \n\t.,'019éßñ日本  😀_-<|>") + ["'s", "<|endoftext|>", " the", "\r\n"]
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert encoder().ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


def reachable(counts, room):
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


def test_fullest_combination_is_the_fullest():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 7))}
        room = rng.randrange(0, 60)
        used = packing.fullest(counts, room)
        assert sum(used) == reachable(counts, room)
        assert all(counts[length] >= n for length, n in Counter(used).items())


def first_fit(lengths, capacity):
    room = []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, r in enumerate(room) if r >= length), None)
        if at is None:
            room.append(capacity - length)
        else:
            room[at] -= length
    return len(room)


def test_bins_hold_every_length_once():
    rng = random.Random(3)
    for _ in range(50):
        histogram = {rng.randrange(1, 65): rng.randrange(1, 30) for _ in range(20)}
        bins = packing.minimum_slack(histogram, 64)
        assert all(sum(combination) <= 64 for combination, _ in bins)
        total = Counter()
        for combination, times in bins:
            for length in combination:
                total[length] += times
        assert total == Counter(histogram)
        used = sum(times for _, times in bins)
        assert used <= 1.02 * first_fit(list(Counter(histogram).elements()), 64) + 1
    assert packing.minimum_slack({}) == []
    with pytest.raises(ValueError):
        packing.minimum_slack({65: 1}, 64)


def check(rows, texts, capacity):
    """Every document whole and in order, every sequence without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids = np.array(encoder().ids(texts[doc_id] or "") + [0], "<u4")
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == capacity for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= capacity
    return len(by_sequence)


def test_pieces_fill_sequences(spark):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choices(["the", "word", "xyzzy", "12"], k=rng.choice([0, 3, 40, 63, 64, 65, 200]))) for i in range(150)}
    docs = documents(spark, list(texts.values())).repartition(6)
    rows = packing.pack(spark, docs, 64).collect()
    used = check(rows, texts, 64)
    assert used <= first_fit([r.length for r in rows], 64)
    with_ids = packing.pack(spark, docs, 64, keep_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)


def test_awkward_rows(spark):
    rows = packing.pack(spark, awkward(spark)).collect()
    assert sum(r.length == 1 for r in rows) >= 3
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert packing.pack(spark, empty(spark)).count() == 0
