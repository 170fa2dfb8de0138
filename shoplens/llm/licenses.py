"""Licence notices by Dice coefficient over word bigrams, with DataFrame functions only.

:func:`scan` compares a text line by line and as a whole; :func:`scan_anywhere` adds the notices
that cross line ends or share a line with other words, and the full licence texts of ``bodies/``.  Normalised: lower case, everything
but ASCII letters and digits a blank.  With a different bigrams on one side and b on the
other the coefficient is at most 2 min(a, b) / (a + b), so only templates whose size
lies between t / (2 - t) and (2 - t) / t times that of the line are compared at all.
Of several templates at or above the threshold the closest counts, ties by name.

Defined results: a null or empty text, and a line of one word, hold no notice; a notice
that occurs again is listed once and counted each time; a text of one line is compared
once; null ids, repeated rows and further columns do no harm.  An empty table gives no
rows.  A text of any length is compared whole, in one task; the time for one that holds
most of a full licence text, but broken in many places, grows with the breaks times the
template's length.

Windows of words, for :func:`scan_anywhere`: any run of the text's words, across line ends, of at
most (2 - t) / t times the template's length, with the Dice test on its different bigrams.  A
window grown by a bigram of the template never scores less, so only windows that begin and end
where a run of such bigrams does (or with the template's own first or last) are tried.  Of windows
that overlap the closest counts, ties by name, then by place; notices and full texts
are kept apart, as a full text may quote a notice.  A match of a line (or, where no line has that
notice, of the whole text) stands for the closest of its windows, which comes first and is not counted again.  A template needs at least
t / (2 - t) of its bigrams in the text, so a text without any of the rest plus one (``_keys``) is not looked at.
"""

from __future__ import annotations

import math
import pkgutil
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Notices by licence.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


# Full texts, from ``bodies/`` (without copyright lines and appendices).
BODIES = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0",
          "Unlicense"]


def body(name: str) -> str:
    return pkgutil.get_data(__package__, f"bodies/{name}.txt").decode()


def bigram_list(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bigrams_of(text: str) -> set[str]:
    return set(bigram_list(text))


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Numbers of bigrams that can reach the threshold beside a template of ``n``, widened by rounding."""
    return int(threshold / (2 - threshold) * n), int((2 - threshold) / threshold * n) + 1


def _best(threshold: float) -> str:
    """SQL for the closest template of the bigrams ``bg``, or null."""
    candidates = []
    for name, text in sorted(TEMPLATES):
        own = sorted(bigrams_of(text))
        low, high = size_bounds(len(own), threshold)
        listed = ", ".join(f"'{b}'" for b in own)
        dice = f"2D * size(array_intersect(bg, array({listed}))) / (size(bg) + {len(own)})"
        # the largest struct wins: the rank turns later names into smaller numbers
        candidates.append(f"if(size(bg) BETWEEN {low} AND {high}, named_struct("
                          f"'dice', {dice}, 'rank', -{len(candidates)}, 'name', '{name}'), null)")
    return f"array_max(filter(array({', '.join(candidates)}), c -> c.dice >= {threshold}D))"


def matches(threshold: float = THRESHOLD) -> Column:
    """Notices in ``text``: array of (line from 0, or -1 for the whole text, name, dice), by line."""
    units = ("transform(array(split(coalesce(text, ''), '\\n', -1)), ls -> "
             "if(size(ls) = 1, transform(ls, l -> named_struct('line', 0, 'unit', l)), "
             "concat(array(named_struct('line', -1, 'unit', text)), "
             "transform(ls, (l, i) -> named_struct('line', i, 'unit', l)))))[0]")
    words = "filter(split(lower(u.unit), '[^a-z0-9]+'), w -> w <> '')"
    pairs = (f"transform(array({words}), ws -> if(size(ws) < 2, cast(array() as array<string>), "
             "array_distinct(transform(sequence(0, size(ws) - 2), i -> concat(ws[i], ' ', ws[i + 1])))))")
    found = f"transform({pairs}, bg -> {_best(threshold)})[0]"
    return F.expr(f"filter(transform({units}, u -> named_struct('line', u.line, 'best', {found})), m -> m.best IS NOT NULL)")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, n_matches, licenses (names, sorted, comma-joined), places (line:name), best_dice (0 without)."""
    return _listed(docs.select("doc_id", matches(threshold).alias("m")))


def _listed(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.size("m").cast("long").alias("n_matches"),
        F.expr("array_join(array_sort(array_distinct(transform(m, x -> x.best.name))), ',')").alias("licenses"),
        F.expr("array_join(transform(m, x -> concat(x.line, ':', x.best.name)), ',')").alias("places"),
        F.expr("coalesce(array_max(transform(m, x -> x.best.dice)), 0D)").alias("best_dice"))


def least_shared(n: int, threshold: float = THRESHOLD) -> int:
    """Bigrams of a template of ``n`` that any window at the threshold holds."""
    return math.ceil(threshold / (2 - threshold) * n - 1e-9)


def _keys(own: set[str], threshold: float) -> list[str]:
    """So many of the template's bigrams that a match holds one of them; those of long words, which few texts have."""
    order = sorted(own, key=lambda b: (min(map(len, b.split())), len(b), b), reverse=True)
    return order[:len(own) - least_shared(len(own), threshold) + 1]


def _strings(values: list[str]) -> str:
    return f"split('{'|'.join(values)}', '[|]')"


def _windows(threshold: float) -> str:
    """SQL for the windows of the text ``t`` beside its matches ``m``: array of (line, at, best), without overlap."""
    templates, keys = [], set()
    for kind, named in enumerate([sorted(TEMPLATES), [(name, body(name)) for name in BODIES]]):
        for rank, (name, text) in enumerate(named):
            order = bigram_list(text)
            own = sorted(set(order))
            keys.update(_keys(set(own), threshold))
            longest = size_bounds(len(order), threshold)[1]
            templates.append(
                f"named_struct('kind', {kind}, 'rank', -{rank}, 'name', '{name}', 'n', {len(own)}, "
                f"'least', {least_shared(len(own), threshold)}, 'longest', {longest}, 'first', '{order[0]}', "
                f"'last', '{order[-1]}', 'own', {_strings(own)})")
    let = lambda name, value, then: f"transform(array({value}), {name} -> {then})[0]"

    # the ends of one start, at most ``longest`` bigrams on: a bigram counts where it stands first in the window
    first = "if(seen[j] < a, 1, 0)"
    step = (f"named_struct('s', acc.s + if(hit[j], {first}, 0), 'm', acc.m + {first}, 'out', acc.out)")
    dice = f"2D * s.s / (s.m + tpl.n)"
    found = ("named_struct('dice', " + dice + ", 'a', a, 'b', j, 'line', ws[a].line, 'to', ws[j + 1].line)")
    grown = let("s", step, f"if(hit[j] AND (NOT coalesce(try_element_at(hit, j + 2), false) OR bs[j] = tpl.last) AND {dice} >= {threshold}D, "
                           f"named_struct('s', s.s, 'm', s.m, 'out', concat(s.out, array({found}))), s)")
    ends = (f"aggregate(sequence(a, least(a + tpl.longest - 1, size(bs) - 1)), named_struct('s', 0, 'm', 0, 'out', "
            "cast(array() as array<struct<dice: double, a: int, b: int, line: int, to: int>>)), "
            f"(acc, j) -> {grown}, acc -> acc.out)")
    starts = ("filter(sequence(0, size(bs) - 1), a -> hit[a] AND "
              "(a = 0 OR NOT hit[greatest(a - 1, 0)] OR bs[a] = tpl.first))")
    taken = ("tpl.kind = 0 AND exists(m, u -> u.best.name = tpl.name AND (u.line = x.line AND x.line = x.to "
             "OR u.line = -1 AND NOT exists(m, v -> v.line >= 0 AND v.best.name = tpl.name)))")
    of_one = let("hit", "transform(bs, b -> array_contains(tpl.own, b))",
                 f"transform(flatten(transform({starts}, a -> {ends})), x -> named_struct("
                 f"'taken', {taken}, 'dice', x.dice, 'rank', tpl.rank, 'back', -x.a, 'b', -x.b, 'line', x.line, 'kind', tpl.kind, 'name', tpl.name, "
                 "'of', if(exists(m, u -> u.line = x.line AND u.best.name = tpl.name), x.line, -1)))")
    # the largest struct first: what a line already matched, then the closest
    ordered = f"sort_array(flatten(transform(near, tpl -> {of_one})), false)"
    apart = (f"aggregate({ordered}, cast(array() as array<struct<taken: boolean, dice: double, rank: int, back: int, b: int, "
             "line: int, kind: int, name: string, of: int>>), (acc, x) -> if(exists(acc, y -> y.kind = x.kind AND -y.back <= -x.b + 1 "
             "AND -x.back <= -y.b + 1 OR x.taken AND y.taken AND y.name = x.name AND y.of = x.of), acc, concat(acc, array(x))))")
    kept = (f"transform(filter({apart}, x -> NOT x.taken), x -> named_struct('line', x.line, 'at', -x.back, "
            "'best', named_struct('dice', x.dice, 'rank', x.rank, 'name', x.name)))")
    # for every bigram the place where it stood last, or -1
    sorted_ = "sort_array(transform(bs, (b, i) -> named_struct('b', b, 'i', i)))"
    seen = let("so", sorted_, "transform(sort_array(transform(so, (x, k) -> named_struct('i', x.i, 'p', "
                              "if(k > 0 AND so[greatest(k - 1, 0)].b = x.b, so[greatest(k - 1, 0)].i, -1)))), x -> x.p)")
    placed = ("flatten(transform(split(t, '\\n', -1), (l, i) -> transform("
              "filter(split(lower(l), '[^a-z0-9]+'), w -> w <> ''), w -> named_struct('w', w, 'line', i))))")
    pairs = "transform(sequence(0, size(ws) - 2), i -> concat(ws[i].w, ' ', ws[i + 1].w))"
    near = f"filter(array({', '.join(templates)}), tpl -> size(array_intersect(own, tpl.own)) >= tpl.least)"
    none = "cast(array() as array<struct<line: int, at: int, best: struct<dice: double, rank: int, name: string>>>)"
    looked = let("ws", placed, let("bs", pairs, let("own", "array_distinct(bs)", let(
        "near", near, f"if(size(near) = 0, {none}, {let('seen', seen, kept)})"))))
    words = "filter(split(lower(t), '[^a-z0-9]+'), w -> w <> '')"
    quick = let("qs", words, "size(qs) > 1 AND arrays_overlap(transform(sequence(0, greatest(size(qs) - 2, 0)), "
                             f"i -> concat(qs[i], ' ', coalesce(try_element_at(qs, i + 2), ''))), {_strings(sorted(keys))})")
    return f"if({quick}, {looked}, {none})"


def scan_anywhere(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """:func:`scan` with the notices within and across lines and the full texts, at the line of their first word."""
    found = docs.select("doc_id", F.expr("coalesce(cast(text as string), '')").alias("t"), matches(threshold).alias("m"))
    lines = "transform(m, u -> named_struct('line', u.line, 'at', -1, 'best', u.best))"
    every = found.select("doc_id", F.expr(f"sort_array(concat({lines}, {_windows(threshold)}))").alias("m"))
    return _listed(every)
