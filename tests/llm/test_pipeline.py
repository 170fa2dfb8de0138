"""The pipeline against the brute-force versions of its stages."""

import os
import random

import pytest

import corpus_pipeline
from shoplens.llm import quality
from tests.llm import test_decontam, test_linededup, test_minhash, test_packing, test_quality

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(21)
    items = [(i, " ".join(f"bench{i}w{rng.randrange(40)}" for _ in range(30))) for i in range(4)]
    texts = []
    for i in range(70):
        words = [f"d{i}w{rng.randrange(200)}" for _ in range(80)]
        lines = [" ".join(words[a:a + 20]) for a in range(0, 80, 20)]
        if i % 3 == 0:
            lines.insert(2, "A line that " + " ".join(f"many{j}" for j in range(60)))
        if i % 7 == 0:
            lines.append(" ".join(items[i % 4][1].split()[4:20]))
        texts.append("\n".join(lines))
        if i % 5 == 0:
            texts.append(texts[-1].replace(words[3], f"edit{i}", 1))
        if i % 11 == 0:
            texts += [texts[-1]] * 2
    texts += ["", None, "too short", "#% $& " * 100, "word again " * 80]
    rng.shuffle(texts)
    return texts, items


def test_run_equals_brute_force(spark, tmp_path):
    texts, items = corpus()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, FIELDS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [(i, t) for i, t in enumerate(texts) if not any(rule(quality.Text((t or "").encode())) for rule in quality.RULES.values())]
    assert all(test_quality.brute(t)[-1] is False for _, t in kept)
    kept = [(i, t) for (i, _), t in zip(kept, test_linededup.brute([t for _, t in kept], 10))]
    first = {group[0] for group in test_minhash.brute_classes(kept)}
    kept = [(i, t) for i, t in kept if i in first]
    hit = test_decontam.brute([t for _, t in kept], items)
    kept = {i: t for (i, t), h in zip(kept, hit) if not h[-1]}
    assert 10 < len(kept) < len(texts)
    test_packing.check(found, kept, 2048)


def test_stages_keep_the_columns(spark, tmp_path):
    texts, items = corpus()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, FIELDS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(spark, stage(spark, docs, str(tmp_path)), name)
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], FIELDS).schema]
        assert docs.where("n_chars <> length(text)").count() == 0


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], FIELDS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_on_the_smallest_tables(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len({r.doc_id for r in rows}) <= 200


def test_every_stage_takes_awkward_rows(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = [None, "", " \n ", "one", "same line\nother", "same line\nother", long, "é\n\n\t \nÉ", None]
    ids = [1, 2, None, 3, 4, 4, 5, 6, None]
    schema = FIELDS + ", _k1 string, words int, gone string"
    docs = spark.createDataFrame([(i, t, "en", None, 0, "k", 1, "g") for i, t in zip(ids, texts)], schema)
    spark.createDataFrame([(1, "one"), (2, None), (None, "other")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        left[name] = sorted((r.doc_id if r.doc_id is not None else -1) for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert left["quality_rules"] == [5]
    assert left["line_dedup"] == [-1, -1, 1, 2, 3, 4, 4, 5, 6]
    assert left["minhash_near_dedup"] == [1, 3, 4, 5, 6]  # texts without a word are one class
    assert left["benchmark_decontamination"] == [-1, -1, 1, 2, 5, 6]
    assert set(left["best_fit_packing"]) == {-1, 1, 2, 3, 4, 5, 6}


def test_line_dedup_counts_characters_of_a_missing_text(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 7), (2, "ab", "en", "s", 2)], FIELDS)
    assert {r.doc_id: r.n_chars for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == {1: 0, 2: 2}
