"""Benchmark decontamination by winnowing, with DataFrame and SQL functions only.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case.  Of
every ``WINDOW - GRAM + 1`` neighbouring hashes of ``GRAM`` words the smallest is
kept, in documents and in benchmark items.  A shared span of ``WINDOW`` words holds
the same hashes on both sides and so shares its smallest: every such span is found.

Kept hashes of documents are joined with those of the benchmark.  Where a document
has a hit, the hit is extended: each window of ``WINDOW`` words around it is compared
with the windows of the items word for word, so a hash collision changes nothing.
An item of fewer words is one window; for the few lengths below ``WINDOW`` that occur
in the benchmark, all hashes of so many words are kept.

The benchmark side is broadcast only where Spark finds it below its threshold.

Defined results: a null text has no words; repeated rows, and rows that agree in id
and text, get the same result; items without words do not occur; an item without an
id marks words but is not counted; no documents give no rows.  A text of any length is
searched whole; the steps for a text grow with its words times the square root of its
known hashes at most.  Further columns of either table are left out, or passed through
where documents are returned.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import KEY, keep, own_columns, row_key

WINDOW = 10  # words of a shared span that must be found
GRAM = 5  # words of a fingerprint

_NOT_WORD = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORDS = (
    f"array_remove(split(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
    f"'{_NOT_WORD}'), '')")


def _let(name: str, value: str, body: str) -> str:
    """``body`` for one evaluation of ``value``; ``body`` is an array."""
    return f"flatten(transform(array({value}), {name} -> {body}))"


def _gram(words: str, first: str, n: int) -> str:
    """Hash of ``n`` words, other hashes for other ``n``."""
    return f"xxhash64({n}, " + ", ".join(f"get({words}, {first} + {j})" for j in range(n)) + ")"


def _grams(words: str, n: int) -> str:
    return f"transform(sequence(0, size({words}) - {n}), i -> {_gram(words, 'i', n)})"


def fingerprints(words: str, short: list[int], window: int, gram: int) -> str:
    """SQL for the kept hashes of an array of words."""
    span = window - gram + 1
    smallest = "least(" + ", ".join(f"get(hs, j + {d})" for d in range(span)) + ")" if span > 1 else "get(hs, j)"
    kept = _let("hs", _grams(words, gram), f"transform(sequence(0, size(hs) - {span}), j -> {smallest})")
    none = "cast(array() as array<bigint>)"
    parts = [f"if(size({words}) >= {window}, {kept}, {none})"]
    parts += [f"if(size({words}) >= {n}, {_grams(words, n)}, {none})" for n in short]
    return f"array_distinct(concat({', '.join(parts)}))"


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """One row per item and window: item_id, words joined by blanks, their number."""
    shape = ("transform(sequence(0, greatest(size(ws) - {w}, 0)), "
             "i -> named_struct('item_id', item_id, 'span', array_join(slice(ws, i + 1, {w}), ' '), "
             "'n', least(size(ws), {w})))").format(w=window)
    none = "cast(array() as array<struct<item_id: {}, span: string, n: int>>)".format(
        benchmark.schema["item_id"].dataType.simpleString())
    rows = benchmark.select(F.expr(f"inline({_let('ws', WORDS, f'if(size(ws) > 0, {shape}, {none})')})"))
    return rows.distinct()


def _marks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, short: list[int],
           window: int, gram: int) -> DataFrame:
    """Per document its number of words, its copies, and the benchmark's hashes that it holds."""
    kept = fingerprints("ws", short, window, gram)
    targets = benchmark.select(F.expr(f"explode({_let('ws', WORDS, kept)})").alias("fp")).distinct()
    # the first row of a document has no hash and carries its number of words through the join
    rows = f"transform(concat(array(cast(null as bigint)), {kept}), h -> named_struct('fp', h, 'n_words', size(ws)))"
    exploded = docs.select(*row_key(), "doc_id", F.expr(f"inline({_let('ws', WORDS, rows)})"))
    known = exploded.join(targets.withColumn("known", F.lit(True)), "fp", "left").where("fp IS NULL OR known")
    return keep(spark, known.groupBy(*KEY).agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(F.col("fp").isNull()).alias("copies"),
        F.collect_set("fp").alias("fps")), "marks")


def _around(words: str, n: int, part: int) -> str:
    """SQL for the windows of ``n`` words that hold a known hash of ``part`` words."""
    # the known hashes lie in about as many buckets as a bucket has hashes, so a look-up asks few of them
    buckets = "transform(sequence(0, b - 1), k -> filter(fps, f -> pmod(f, b) = k))"
    hits = _let("gs", _grams(words, part), _let("b", "greatest(cast(sqrt(size(fps)) as int), 1)", _let(
        "bs", buckets, "filter(sequence(0, size(gs) - 1), i -> array_contains(get(bs, cast(pmod(get(gs, i), b) as int)), get(gs, i)))")))
    starts = (f"filter(array_distinct(flatten(transform({hits}, i -> sequence(greatest(i - {n - part}, 0), i)))), "
              f"s -> s <= size({words}) - {n})")
    spans = (f"transform({starts}, s -> named_struct("
             f"'start', s, 'span', array_join(slice({words}, s + 1, {n}), ' '), 'n', {n}))")
    return f"if(size({words}) >= {n}, {spans}, cast(array() as array<struct<start: int, span: string, n: int>>))"


def _extended(docs: DataFrame, marks: DataFrame, items: DataFrame, short: list[int],
              window: int, gram: int) -> DataFrame:
    """Per document with an occurring window: how many words are hit, and the items."""
    touched = marks.where("size(fps) > 0").select(*KEY, "fps")
    keyed = docs.select(*row_key(), "text")
    found = keyed.join(touched, KEY)
    around = ", ".join(_around("ws", n, part) for n, part in [(window, gram), *((n, n) for n in short)])
    windows = found.select(*KEY, F.expr(f"inline({_let('ws', WORDS, f'concat({around})')})"))
    occurring = windows.join(items, ["span", "n"])
    grouped = occurring.groupBy(*KEY).agg(
        F.collect_set(F.struct("start", "n")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = "size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.n - 1)))))"
    return grouped.select(*KEY, F.expr(covered).cast("long").alias("n_hit"), "items")


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: its key, doc_id, n_words, copies (rows of it), n_hit, items (ids of occurring items)."""
    benchmark = benchmark.select("item_id", "text")
    lengths = benchmark.select(F.expr(f"size({WORDS})").alias("n")).where(f"n BETWEEN 1 AND {window - 1}").distinct()
    short = sorted(r["n"] for r in lengths.collect())  # below ``window`` of them
    marks = _marks(spark, docs, benchmark, short, window, gram)
    hits = _extended(docs, marks, _windows(benchmark, window), short, window, gram)
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    return marks.join(hits, KEY, "left").select(
        *KEY, "doc_id", "n_words", "copies",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.expr(f"cast(array() as array<{id_type}>)")).alias("items"))


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row."""
    found = contamination(spark, docs, benchmark)
    listed = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    rows = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit word, with their own columns."""
    inputs = own_columns(docs, [])
    hit = contamination(spark, docs, benchmark).where("n_hit > 0").select(*KEY)
    keyed = docs.select(*row_key(), F.struct(*inputs).alias("_row"))
    return keyed.join(hit, KEY, "left_anti").select("_row.*")
