import random

from shoplens.llm import tokencount
from shoplens.llm.tokens import encoder
from tests.llm.common import awkward, documents, empty

PARTS = ["the", "ab", "x1", "  ", "\n", "\n\n", " ", "'s", "don't", "é", "日本", ".", ",,", "\t", "long" * 40, " "]


def some_text(rng, n):
    return "".join(rng.choice(PARTS) + rng.choice([" ", " ", ""]) for _ in range(n))


def replayed(text, edits):
    for start, end, new in edits:
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        text = text[:start] + new + text[end:]
    return text


def test_edited_trees_equal_a_fresh_count():
    rng = random.Random(7)
    for _ in range(150):
        text = some_text(rng, rng.randrange(1200))
        tree = tokencount.Tree(text)
        assert tree.total == encoder().count(text)
        for _ in range(6):
            start = rng.randrange(-3, len(text) + 4)
            edit = (start, start + rng.choice([-2, 0, 1, 7, 400]), some_text(rng, rng.choice([0, 1, 3, 900])))
            text = replayed(text, [edit])
            tree.edit(*edit)
            assert tree.text == text and tree.total == encoder().count(text)
            assert sum(tree.leaves[0]) == len(text)


def test_only_the_region_is_encoded():
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = tokencount.Tree(text)
    assert tree.encoded == len(text)
    tree.edit(90_000, 90_004, "new")
    assert tree.encoded - len(text) < 4 * tokencount.LEAF


def test_table_of_edits(spark):
    rng = random.Random(9)
    texts = [some_text(rng, 300) for _ in range(30)]
    edits = [(rng.randrange(33), seq, rng.randrange(400), rng.randrange(500), some_text(rng, 3)) for seq in range(150)]
    edits += [(None, 1, 0, 5, "x")]
    table = spark.createDataFrame(edits, "doc_id long, seq long, start long, end long, replacement string")
    rows = tokencount.apply_edits(tokencount.build(documents(spark, texts).repartition(4)), table).collect()
    assert len(rows) == 30
    for r in rows:
        own = [(s, e, n) for d, _, s, e, n in edits if d == r.doc_id]
        text = replayed(texts[r.doc_id], own)
        assert (r.text, r.n_tokens, r.n_edits) == (text, encoder().count(text), len(own))
        assert r.n_tokens_before == encoder().count(texts[r.doc_id])
        assert sum(r.leaf_tokens) == r.n_tokens


def test_state_can_be_edited_again(spark):
    first = tokencount.apply_edits(tokencount.build(documents(spark, ["a b c " * 400])),
                                   spark.sql("SELECT 0L doc_id, 0L seq, 3L start, 9L end, 'zz' replacement"))
    again = tokencount.apply_edits(first, spark.sql("SELECT 0L doc_id, 0L seq, 1L start, 1L end, CAST(NULL AS STRING) replacement"))
    r = again.collect()[0]
    assert r.n_tokens == encoder().count(r.text) and r.reencoded < 3 * tokencount.LEAF


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = tokencount.recounted(docs, tokencount.sample_edits(docs)).collect()
    assert len(rows) == docs.count()
    assert sum(r.n_edits for r in rows if r.doc_id == 4) == 6 and all(r.n_edits == 0 for r in rows if r.doc_id is None)
    assert tokencount.recounted(empty(spark), tokencount.sample_edits(empty(spark))).count() == 0
