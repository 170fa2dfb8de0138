import random
import re

from shoplens.llm import licenses
from tests.llm.common import awkward, documents, empty


def brute(text):
    lines = (text or "").split("\n")
    units = list(enumerate(lines)) if len(lines) == 1 else [(-1, text), *enumerate(lines)]
    found = []
    for line, unit in units:
        own, best = licenses.bigrams_of(unit), None
        for name, template in sorted(licenses.TEMPLATES):
            other = licenses.bigrams_of(template)
            dice = 2 * len(own & other) / (len(own) + len(other)) if own else 0
            if dice >= licenses.THRESHOLD and (best is None or dice > best[0]):
                best = dice, name
        if best:
            found.append((line, best[1], best[0]))
    return (len(found), ",".join(sorted({n for _, n, _ in found})), ",".join(f"{i}:{n}" for i, n, _ in found),
            max([d for *_, d in found], default=0.0))


def test_equals_brute_force(spark):
    texts = []
    for _, template in licenses.TEMPLATES:
        words = template.split()
        texts += [template, template.upper(), f"before\n{template}\nafter", " ".join(words[1:]), " ".join(words[:len(words) // 2]),
                  template + " with more", "x " + template.replace("the", "a"), "\n".join([template, "other", template])]
    docs = documents(spark, texts)
    found = {r.doc_id: (r.n_matches, r.licenses, r.places, r.best_dice) for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [brute(t) for t in texts]
    assert sum(f[0] > 0 for f in found.values()) > len(licenses.TEMPLATES) * 4


def test_size_bounds_lose_nothing():
    for t in (0.5, 0.8, 0.95):
        for n in range(1, 60):
            low, high = licenses.size_bounds(n, t)
            assert all(low <= m <= high for m in range(1, 200) if 2 * min(m, n) / (m + n) >= t)


def test_awkward_rows(spark):
    found = licenses.scan(awkward(spark)).collect()
    assert len(found) == awkward(spark).count() and all(r.n_matches == 0 and r.licenses == "" for r in found)
    assert licenses.scan(empty(spark)).count() == 0
    assert all(re.fullmatch("[a-z0-9]+ [a-z0-9]+", b) for _, t in licenses.TEMPLATES for b in licenses.bigrams_of(t))


def anywhere(spark, texts):
    rows = licenses.scan_anywhere(documents(spark, texts)).collect()
    return [(r.n_matches, r.licenses, r.places, round(r.best_dice, 9)) for r in sorted(rows, key=lambda r: r.doc_id)]


def brute_windows(text, every_window=False):
    """The closest of the windows of every notice that overlap; those from run to run of its bigrams, or all."""
    count, _, places, best = brute(text)
    units = [(int(p.split(":")[0]), p.split(":")[1]) for p in places.split(",") if p]
    words = [(w, i) for i, line in enumerate((text or "").split("\n")) for w in re.findall("[a-z0-9]+", line.lower())]
    pairs = [f"{a} {b}" for (a, _), (b, _) in zip(words, words[1:])]
    found = []
    for name, template in licenses.TEMPLATES:
        own = licenses.bigrams_of(template)
        order = licenses.bigram_list(template)
        first_of, last_of, longest = order[0], order[-1], licenses.size_bounds(len(order))[1]
        for a in range(len(pairs)):
            for b in range(a, min(a + longest, len(pairs))):
                window = set(pairs[a:b + 1])
                dice = 2 * len(own & window) / (len(own) + len(window))
                inner = (a > 0 and pairs[a - 1] in own and pairs[a] != first_of or pairs[a] not in own
                         or b + 1 < len(pairs) and pairs[b + 1] in own and pairs[b] != last_of or pairs[b] not in own)
                if dice >= licenses.THRESHOLD and (every_window or not inner):
                    first, last = words[a][1], words[b + 1][1]
                    taken = any(n == name and (i == first == last or i == -1 and not any(
                        j >= 0 and k == name for j, k in units)) for i, n in units)
                    of = first if (first, name) in units else -1
                    found.append((not taken, -dice, name, a, b, of))
    apart = []
    for x in sorted(found):
        if all((y[4] + 1 < x[3] or x[4] + 1 < y[3]) and (x[0] or y[0] or (x[2], x[5]) != (y[2], y[5])) for y in apart):
            apart.append(x)
    new = [(words[x[3]][1], x[3], x[2], -x[1]) for x in apart if x[0]]
    every = sorted([(i, -1, n, 0) for i, n in units] + new)
    return (len(every), ",".join(sorted({n for _, _, n, _ in every})), ",".join(f"{i}:{n}" for i, _, n, _ in every),
            round(max([best, *(d for *_, d in new)]), 9))


def test_notices_across_lines_and_within_them(spark):
    filler = "some words before it\n" * 9
    wrapped = "This work is licensed under the\nGNU General Public License, version 3."
    found = anywhere(spark, [filler + wrapped + "\n" + filler, "Copyright 2024 Acme Corp. All rights reserved.",
                             "Copyright (c) 2020 Jane Doe. Released under the MIT License.",
                             "Released under the MIT License. All rights reserved.\n" + filler])
    assert found == [(1, "GPL-3.0", "9:GPL-3.0", 1.0), (1, "Proprietary", "0:Proprietary", 1.0), (1, "MIT", "0:MIT", 1.0),
                     (2, "MIT,Proprietary", "0:MIT,0:Proprietary", 1.0)]


def test_windows_equal_brute_force(spark):
    rng, texts = random.Random(4), []
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += rng.choices(["all", "the", "rights", "license", "x", "under", "work"], k=rng.randrange(0, 6))
            notice = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randrange(0, 3)):
                notice[rng.randrange(len(notice))] = rng.choice(["", "and", "the", "of all"])
            words += notice * rng.randrange(1, 3)
        texts.append("".join(w + rng.choice("      \n") for w in words))
    found = anywhere(spark, texts)
    assert found == [brute_windows(t) for t in texts]
    everything = [brute_windows(t, every_window=True) for t in texts]  # the windows left out are never closer, and never alone
    assert all((f[0] > 0) == (e[0] > 0) and f[3] >= e[3] for f, e in zip(found, everything))


def test_full_texts(spark):
    filler = "nothing of the kind in this line\n" * 40
    cut = lambda text: " ".join(w for i, w in enumerate(text.split()) if i % 25)  # one word of 25 lost
    for make in (lambda b: b, lambda b: filler + "Copyright 2001 A. Nother\n\n" + b + filler, cut):
        found = anywhere(spark, [make(licenses.body(name)) for name in licenses.BODIES])
        assert all(name in f[1].split(",") for name, f in zip(licenses.BODIES, found))
    assert anywhere(spark, [licenses.body("MIT") + filler + licenses.body("MIT") + licenses.body("BSD-3-Clause")])[0][:2] == (
        3, "BSD-3-Clause,MIT")


def test_awkward_rows_anywhere(spark):
    found = licenses.scan_anywhere(awkward(spark)).collect()
    assert len(found) == awkward(spark).count() and all(r.n_matches == 0 for r in found)
    assert licenses.scan_anywhere(empty(spark)).count() == 0
