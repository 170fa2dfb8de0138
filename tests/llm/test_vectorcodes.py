import hashlib
import math
import random

import pytest

from shoplens.llm import registry, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, error string, _label int, code int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "e", 1, 2) for i, v, label in rows], SCHEMA)


def brute(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error, codebooks digest, in plain Python."""
    kept = [(i, v, label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[[math.floor(256 * x) for x in v[p * width:(p + 1) * width]] for p in range(parts)] for _, v, _ in kept]
    first = sorted({i: c for (i, _, _), c in reversed(list(zip(kept, cut)))}.items())[:entries]
    books = [[list(c[p]) for _, c in first] for p in range(parts)]

    def best(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(best(c[p], books[p])[1], []).append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, labels = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [best(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        labels[label] = labels.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    return [(i, code, error, labels[label], digest) for i, code, error, label in out]


def found(df):
    return [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def vectors(seed, n, dim=32):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(9)]
    rows = []
    for i in range(n):
        v = [float(int(1024 * rng.gauss(x, 0.1))) / 1024 for x in rng.choice(centres)]
        rows.append((i * 3, v, rng.choice([None, 1, 2, 3])))
    return rows


def test_codes_equal_brute_force(spark):
    rows = vectors(1, 300)
    bad = [(-5, None, 1), (-4, [], 1), (-3, [None] * 32, 1), (-2, [float("nan")] + [0.0] * 31, 2), (-1, [float("inf")] * 32, 2)]
    assert order(found(vectorcodes.compress(spark, frame(spark, rows + bad)))) == order(brute(rows + bad))


def test_one_vector_holds_a_third_of_all_rows(spark):
    rows = vectors(2, 200)
    rows += [(1000 + i, rows[7][1], 9) for i in range(100)]
    assert order(found(vectorcodes.compress(spark, frame(spark, rows), rounds=3))) == order(brute(rows, rounds=3))
    few = vectors(3, 5)
    assert order(found(vectorcodes.compress(spark, frame(spark, few)))) == order(brute(few))


def test_owners_keep_their_members(spark):
    rows = frame(spark, vectors(4, 400))
    whole = vectorcodes.finite(rows)
    book = vectorcodes.seeds(whole, 16, 64)
    members = vectorcodes.keep(spark, vectorcodes.settled(whole, book, 4), "members")
    new = vectorcodes.updated(members, book)
    moved = vectorcodes.reassigned(members, new)
    migrating = moved.where("next <> entry").count()
    assert 0 < migrating < 0.5 * moved.count() == 0.5 * 400 * 16
    after = vectorcodes.migrated(spark, members, new)
    assert after.count() == 400 * 16
    assert vectorcodes.reassigned(after, new).where("next <> entry").count() == 0


def test_awkward_tables(spark):
    v = [0.5] * 32
    rows = [(None, v, 1), (4, v, None), (4, v, None), (5, [0.25] * 32, None), (6, [1.0] * 16, 1), (7, [3e38] * 32, 1)]
    got = found(vectorcodes.compress(spark, frame(spark, rows)))
    assert sorted(r[0] or -1 for r in got) == [-1, 4, 4, 5, 7] and len({r[1] for r in got if r[0] == 4}) == 1
    assert found(vectorcodes.compress(spark, frame(spark, []))) == []
    assert found(vectorcodes.compress(spark, frame(spark, [(None, v, 1)]))) == []
    odd = found(vectorcodes.compress(spark, frame(spark, [(1, [0.5] * 20, 1), (2, [0.25] * 20, 1)])))
    assert {r[0]: r[2] for r in odd} == {1: 0, 2: 0}


@pytest.mark.parametrize("name", ["op13_vector_codes"])
def test_query_equals_brute_force(spark, name):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert order(found(registry.queries()[name](spark, sf))) == order(brute(rows))
