"""Secrets by patterns and by two Markov models, with DataFrame and SQL functions only.

Patterns give the base spans.  Beside them, runs of ``MIN_RUN`` or more letters, digits
and ``+/_=-`` are scored: the log-likelihood ratio of their neighbouring characters
under a model of random strings and one of ordinary identifiers, both first-order.
A run at ``THRESHOLD`` or above that touches no base span is a span of kind ``random``.

The models are trained on labelled samples from a bounded number of documents
(``TRAIN_DOCUMENTS``, those with the smallest hash of their id): the values of base spans
and digests of the ids in base 64 are labelled random, runs of 8 or more characters in
documents without a base span ordinary.  Counts of character pairs leave Spark, nothing else.

Defined results: a null or empty text has no span; offsets are code points; repeated
rows are scanned alike; without any training rows the smoothed models are equal and
add nothing; further columns are left out.  A text of any length is scanned whole, in
one task; an empty table gives no rows.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_DOCUMENTS = 2_000
MIN_RUN = 12  # shorter runs of either kind can't be told apart
BACK_OFF = 20.0  # pairs that the distribution of single characters counts for in each row
THRESHOLD = 15.0  # natural log; a random run scores about 2 a character

# Kinds in their order, with pattern and least length of what counts
# (for assignments the value, else the match).
_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = rf"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({_VALUE})"""
KINDS = {"assign": (_ASSIGN, 2, 6), "access": ("AKIA[A-Z0-9]{16,}", 0, 20), "hex": ("(?<![0-9a-f])[0-9a-f]{24,}", 0, 24)}
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
_RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
_SPAN = "struct<start: bigint, kind: int, end: bigint, value: string>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found(pattern: str, kind: int, group: int = 0, least: int = 0) -> str:
    """SQL for the spans of a pattern in ``t``, leftmost and without overlap."""
    p = _quoted(pattern)
    value = f"regexp_extract(ms[i], {p}, {group})" if group else "ms[i]"
    begin = "acc.at + length(ps[i])"
    step = (f"named_struct('at', {begin} + length(ms[i]), 'out', concat(acc.out, array(named_struct('start', {begin}, "
            f"'kind', {kind}, 'end', {begin} + length(ms[i]), 'value', {value}))))")
    every = (f"transform(array(regexp_extract_all(t, {p}, 0)), ms -> transform(array(split(t, {p}, -1)), ps -> "
             f"aggregate(sequence(0, size(ms) - 1), named_struct('at', 0L, 'out', cast(array() as array<{_SPAN}>)), "
             f"(acc, i) -> {step}, acc -> acc.out))[0])[0]")
    return (f"if(t RLIKE {p}, filter({every}, s -> length(s.value) >= {least}), "
            f"cast(array() as array<{_SPAN}>))")


def _base() -> str:
    parts = [found(pattern, number, group, least) for number, (pattern, group, least) in enumerate(KINDS.values())]
    return f"array_sort(concat({', '.join(parts)}))"


def with_base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, t (the text), base (spans by start, then kind)."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    return texts.withColumn("base", F.expr(_base()))


def _outside() -> str:
    return "NOT exists(base, b -> b.start < s.end AND s.start < b.end)"


def train(docs: DataFrame, rows: int = TRAIN_DOCUMENTS) -> list[float]:
    """Log-likelihood ratios of random to ordinary, by pair of characters of ``ALPHABET`` and one for all others."""
    ids = docs.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(rows).select("doc_id").distinct()
    sample = with_base_spans(docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text"))  # ``rows`` ids at most
    known = sample.select(F.lit(True).alias("random"), F.explode("base.value").alias("value"))
    ordinary = sample.where("size(base) = 0").select(
        F.lit(False).alias("random"), F.expr(f"explode(regexp_extract_all(t, {_quoted(_RUN % 8)}, 0))").alias("value"))
    digests = ids.select(F.lit(True).alias("random"),
                         F.expr("base64(unhex(sha2(cast(doc_id as string), 256)))").alias("value"))
    pairs = known.unionByName(ordinary).unionByName(digests).where("length(value) > 1").select("random", F.expr(
        "explode(transform(sequence(1, length(value) - 1), i -> substr(value, i, 2)))").alias("pair"))
    size, counts = len(ALPHABET) + 1, {}
    for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect():  # of fewer than 70 characters
        a, b = (ALPHABET.find(c) + 1 for c in r["pair"])
        counts[r["random"], a, b] = counts.get((r["random"], a, b), 0) + r["n"]

    def logs(random: bool) -> list[float]:
        """Log probabilities of the second character given the first, backed off to those of the character alone."""
        rows = [[counts.get((random, a, b), 0) for b in range(size)] for a in range(size)]
        single = [sum(column) + 0.5 for column in zip(*rows)]
        total = sum(single)
        return [math.log((n + BACK_OFF * s / total) / (sum(row) + BACK_OFF)) for row in rows for n, s in zip(row, single)]

    return [round(x - y, 3) for x, y in zip(logs(True), logs(False))]


def with_spans(spark: SparkSession, docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """doc_id, t, base, and spans: the base spans and those that the models add."""
    ratios = ",".join(map(str, model or train(docs)))
    table = f"cast(split('{ratios}', ',') as array<double>)"
    size = len(ALPHABET) + 1
    index = f"instr('{ALPHABET}', substr(s.value, {{}}, 1))"
    score = (f"aggregate(sequence(2, length(s.value)), 0D, (acc, i) -> acc + "
             f"{table}[{index.format('i - 1')} * {size} + {index.format('i')}])")
    added = f"filter({found(_RUN % MIN_RUN, len(KINDS))}, s -> {_outside()} AND {score} >= {THRESHOLD}D)"
    return with_base_spans(docs).withColumn("spans", F.expr(f"array_sort(concat(base, {added}))"))


def listed(column: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = ", ".join(f"'{name}'" for name in [*KINDS, "random"])
    return F.expr(f"array_join(transform({column}, s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')")


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return with_spans(spark, docs).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
