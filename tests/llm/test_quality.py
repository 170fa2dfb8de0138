import re
from collections import Counter

import numpy as np

from shoplens.llm import quality
from tests.llm.common import awkward, documents, empty


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for d in range(3)}
    full = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered))
    return (*counts, len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_counts_equal_brute_force(spark):
    texts = ["a b c a b c", "the cat\nthe cat\nsat " * 30, "#$ | <x> " * 20, "é ü \x0b\x0c x y", "w1 w2 w3 " + "z " * 80,
             " ".join(f"w{i}" for i in range(200)), "a b c d " * 3]
    docs = documents(spark, texts).unionByName(awkward(spark))
    expected = sorted([(r.doc_id, *brute(r.text)) for r in docs.collect()], key=str)
    found = quality.report(docs).drop("kept").collect()
    assert sorted([tuple(r) for r in found], key=str) == expected


def test_verdict_does_not_depend_on_the_order(spark):
    docs = documents(spark, ["#% " * 200, "SHOUT! " * 3, " ".join(f"w{i}" for i in range(90)), None, "W" * 999 + " a" * 60])
    names = list(quality.RULES)
    verdicts = [sorted((r.doc_id, r._kept) for r in quality.cascade(docs, order).collect()) for order in (names, names[::-1])]
    assert verdicts[0] == verdicts[1]
    assert [kept for _, kept in verdicts[0]] == [False, False, True, False, False]
    report = sorted((r.doc_id, r.kept) for r in quality.report(docs).collect())
    assert report == verdicts[0]


def test_rules_go_by_rejections_per_second(spark):
    docs = documents(spark, ["#% word " * 100] * 50)
    first = quality.plan(docs)[0]
    assert quality.RULES[first](quality.Text(b"#% word " * 100))
    assert sorted(quality.plan(docs)) == sorted(quality.RULES)


def test_a_rule_is_measured_on_what_those_before_it_leave():
    names = list(quality.RULES)
    hits, seconds = np.zeros((10, len(names)), bool), np.ones((10, len(names)))
    at = {name: k for k, name in enumerate(names)}
    hits[:6, at["few_words"]] = True  # rejects most
    hits[:5, at["repetitive"]] = True  # rejects many, all of them again
    hits[8:, at["shouting"]] = True  # rejects few, but others
    order = quality.by_rejections_per_second(hits, seconds)
    assert order[:2] == ["few_words", "shouting"] and sorted(order) == sorted(names)
    seconds[:, at["few_words"]] = 100
    assert quality.by_rejections_per_second(hits, seconds)[:2] == ["repetitive", "shouting"]


def test_the_report_asks_the_cascade(spark, monkeypatch):
    text = quality.Text(b"#% word " * 100)
    asked = []
    rules = [lambda t, name=name: asked.append(name) or quality.RULES[name](t) for name in ("symbolic", "few_words")]
    assert quality.verdict(text, rules) == (False, 1) and asked == ["symbolic"]
    docs = documents(spark, ["#% word " * 100, " ".join(f"w{i}" for i in range(90))])
    for order in (list(quality.RULES), list(quality.RULES)[::-1]):
        assert sorted((r.doc_id, r.base_failed, r.kept) for r in quality.report(docs, order).collect()) == [
            (0, True, False), (1, False, True)]


def test_documents_keep_their_columns(spark):
    docs = awkward(spark)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    assert quality.accepted(empty(spark)).count() == 0 and quality.report(empty(spark)).count() == 0
