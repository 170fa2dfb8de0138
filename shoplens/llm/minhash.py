"""Near-duplicates by weighted Jaccard similarity of five-word shingles, 0.8 or more.

1. Documents with equal word sequences are one *node*; all further work is on nodes.
2. BagMinHash signatures (``bagminhash.py``) are cut into 32 bands of 4 slots.  A pair
   at similarity 0.8 misses all bands with a probability below 1e-7.
3. In a bucket every node is compared with one leader, not with all others.  Texts are
   compared exactly, as multisets of shingles.  Links give classes; buckets whose
   nodes are in several classes get one more leader, from the smallest-named class.
4. Pairs of such open buckets that are in different classes were not all compared.
   Their nodes go to an exact index: shingles are ordered from rare to frequent, and
   two similar texts must share one of the first fifth of each, at places that still
   leave room for enough overlap.  A passage that thousands of texts share is frequent,
   so it brings no pairs.  Pairs of the same class are not asked again.
5. The index is first asked in ``TURNS`` turns of linear size: under each shingle all
   nodes are compared with one node of another class, and the classes are made anew.
   So the fragments of a large group of copies grow together before pairs are made;
   the pairs that are left, between texts still in different classes, are all compared.
6. Links of all steps give the final classes, by large-star / small-star rounds.

The order of shingles comes from counts in ``COUNTERS`` hashed counters, a bound that
holds for any input; a coarser order costs time, not links.

Defined results: the class of a document is the smallest id in it (null where no
document of the class has one).  Texts without a word are alike only if they agree
without white space at the ends; null counts as empty.  Texts of one to four words have
one shingle.  Repeated rows are in one class.  Texts of any length are compared whole; two
of them are in one task when their pair is verified.  An empty table gives no rows.
Further columns are left out, or passed through where documents are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm import bagminhash as bag
from shoplens.llm.common import KEY, binaries, keep, own_columns, pieces, row_key, text_bytes

BAND_SLOTS = 4
BANDS = bag.SLOTS // BAND_SLOTS
COUNTERS = 1 << 20
TURNS = 2

_Batches = Iterator[pa.RecordBatch]


def _node(raw: bytes) -> bytes:
    words = bag.normal(raw)
    return xxhash.xxh3_128_digest(words) if words else xxhash.xxh3_128_digest(b"\0" + raw.strip())


def _bands(signatures: np.ndarray) -> np.ndarray:
    slots = bag.mix(signatures.view(np.uint64)).reshape(-1, BANDS, BAND_SLOTS)
    keys = np.zeros(slots.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for slot in range(BAND_SLOTS):
        keys = bag.mix(keys * np.uint64(31) + slots[:, :, slot])
    return keys.view(np.int64)


def signed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row: its key, node, number of shingles, and bands (none without words)."""

    def sign(batches: _Batches) -> _Batches:
        for batch in pieces(batches):
            raws = binaries(batch.column(3))
            nodes = [_node(raw) for raw in raws]
            text, element, count = bag.shingles(raws)
            weight = np.bincount(text, count, len(raws)).astype(np.int64)
            bands = _bands(bag.signatures(len(raws), text, element, count))
            bands = [keys if w else [] for keys, w in zip(bands, weight)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(nodes, pa.binary()), pa.array(weight),
                 pa.array(bands, pa.list_(pa.int64()))], names=[*KEY, "doc_id", "node", "w", "bands"])

    keyed = docs.select(*row_key(), "doc_id", text_bytes().alias("raw"))
    schema = keyed.drop("raw").schema.add("node", "binary").add("w", "long").add("bands", T.ArrayType(T.LongType()))
    return keep(spark, keyed.mapInArrow(sign, schema), "signed")


def _fits(a: str, b: str) -> str:
    """Sizes at which two texts can be similar enough."""
    return f"10 * least({a}, {b}) >= 8 * greatest({a}, {b})"


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of nodes (a, b) whose texts are similar."""

    def compare(batches: _Batches) -> _Batches:
        for batch in pieces(batches, 128):
            left, right = binaries(batch.column(2)), binaries(batch.column(3))
            number = {raw: i for i, raw in enumerate(dict.fromkeys(left + right))}
            text, element, count = bag.shingles(list(number))
            bounds = np.searchsorted(text, np.arange(len(number) + 1))
            part = [(element[x:y], count[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
            alike = [bag.similar(part[number[x]], part[number[y]]) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(alike, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    raw = F.col("text").cast("binary")
    first = texts.select(F.col("node").alias("a"), raw.alias("raw_a"))
    second = texts.select(F.col("node").alias("b"), raw.alias("raw_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "raw_a", "raw_b")
    return both.mapInArrow(compare, "a binary, b binary")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, class) for every node with a link; the class is the smallest node joined to it."""
    digest = [F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))]
    edges = keep(spark, links.select("a", "b").where("a <> b").distinct(), "links")
    known = edges.agg(*digest).first()
    while True:
        # large star: neighbours above a node go to the smallest around it
        both = edges.union(edges.select("b", "a"))
        # minima are written first: a join of two read tables is one whose hot nodes Spark splits
        least = keep(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its neighbours below go to the smallest of them
        large = keep(spark, large, "large")
        lowest = keep(spark, large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", "m"))
        edges = keep(spark, small.where("a <> b").distinct(), "links")
        before, known = known, edges.agg(*digest).first()
        if before == known:
            named = edges.select(F.col("a").alias("node"), F.col("b").alias("class"))
            return named.union(edges.select("b", "b")).distinct()


def _labels(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, class) with classes that are parts of the components: the smallest node within four links downwards."""
    down = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    label = keep(spark, down.groupBy("node").agg(F.min("other").alias("class")), "labels")
    for _ in range(2):
        below = label.select(F.col("node").alias("class"), F.col("class").alias("lower"))
        label = label.join(below, "class", "left").select("node", F.coalesce("lower", "class").alias("class"))
    return keep(spark, label, "labels")


def _open(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several classes, and of each bucket one node of its smallest class."""
    named = buckets.select("band", "node", "w").join(classes, "node", "left").select(
        "band", "node", "w", F.coalesce("class", "node").alias("class"))
    mixed = named.groupBy("band").agg(
        F.min(F.struct("class", F.xxhash64("band", "node"), "node", "w")).alias("top"),
        F.max("class").alias("last")).where("top.class <> last").select("band", "top")
    return named.join(mixed, "band")


def _rarest(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """The first fifth of each text's shingles, rare ones first: node, w, token, place in the order.

    The n-th occurrence of a shingle is a token of its own, so multisets become sets.
    """
    def tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text, element, count = bag.shingles(raw)
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(text, count), bag.mix(np.repeat(element, count) + nth.astype(np.uint64) * np.uint64(0x9E3779B9))

    def tally(batches: _Batches) -> _Batches:
        seen = np.zeros(COUNTERS, np.int64)
        for batch in pieces(batches):
            _, token = tokens(binaries(batch.column(0)))
            seen += np.bincount((token % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(seen)
        for start in range(0, len(at), 50_000):
            part = at[start:start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], names=["counter", "n"])

    counted = texts.select(F.col("text").cast("binary")).mapInArrow(tally, "counter long, n long")
    totals = counted.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()  # COUNTERS rows at most
    counters = np.zeros(COUNTERS, np.int64)
    counters[totals.column("counter").to_numpy()] = totals.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(counters)

    def first_fifth(batches: _Batches) -> _Batches:
        counts = shared.value
        for batch in pieces(batches, 64):
            text, token = tokens(binaries(batch.column(1)))
            order = np.lexsort((token, counts[(token % np.uint64(COUNTERS)).astype(np.int64)], text))
            text, token = text[order], token[order]
            weight = np.bincount(text, minlength=batch.num_rows)
            place = np.arange(len(text)) - np.repeat(np.cumsum(weight) - weight, weight)
            needed = weight - (8 * weight + 9) // 10 + 1
            used = place < needed[text]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text[used])), pa.array(weight[text[used]].astype(np.int64)),
                 pa.array(token[used].view(np.int64)), pa.array(place[used].astype(np.int32))],
                names=["node", "w", "token", "place"])

    return texts.select("node", F.col("text").cast("binary").alias("raw")).mapInArrow(
        first_fifth, "node binary, w long, token long, place int")


def _room(a: str, b: str) -> str:
    """Whether texts whose first shared token has these places can be similar."""
    return f"18 * least(w_{a} - place_{a}, w_{b} - place_{b}) >= 8 * (w_{a} + w_{b}) AND {_fits(f'w_{a}', f'w_{b}')}"


def _named(spark: SparkSession, rare: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of the index under tokens that several classes share, with their classes so far."""
    rows = rare.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    rows = keep(spark, rows, "named")
    several = rows.groupBy("token").agg((F.min("class") != F.max("class")).alias("several")).where("several")
    return keep(spark, rows.join(keep(spark, several.select("token"), "several"), "token"), "named")


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "class", "w", "place")))


def _by_turn(spark: SparkSession, rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of each node with the one node that stands for its token in this turn, unless of one class."""
    rank = F.xxhash64(F.lit(turn), "node" if turn % 2 else "class")
    stands = rows.groupBy("token").agg(F.max(F.struct(rank.alias("rank"), "node", "class", "w", "place")).alias("top"))
    stands = keep(spark, stands.select("token", "top.node", "top.class", "top.w", "top.place"), "stands")
    x, y = _side(rows, "a"), _side(stands, "b")
    able = (x["class_a"] != y["class_b"]) & F.expr(_room("a", "b"))
    return x.join(y, "token").where(able).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _remaining(spark: SparkSession, opened: DataFrame, texts: DataFrame, rare: DataFrame | None = None) -> DataFrame:
    """All pairs of opened nodes that are in different classes and can be similar; ``rare`` is their index if made."""
    nodes = opened.select("node", "class").distinct()
    if rare is None:
        rare = _rarest(spark, texts.join(nodes.select("node"), "node", "left_semi"))
    rows = _named(spark, rare, nodes)
    x, y = _side(rows, "a"), _side(rows, "b")
    able = (x["node_a"] < y["node_b"]) & (x["class_a"] != y["class_b"]) & F.expr(_room("a", "b"))
    return x.join(y, (x["token"] == y["token"]) & able).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def node_classes(spark: SparkSession, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, class) for the nodes that are linked with another; ``rows`` are from :func:`signed`."""
    nodes = keep(spark, rows.groupBy("node").agg(
        F.any_value("w").alias("w"), F.any_value("bands").alias("bands"), F.min(F.struct(*KEY)).alias("key")), "nodes")
    banded = nodes.select("node", "w", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.count("*").alias("n"), F.min(F.struct("node", "w")).alias("leader"))
    leaders = keep(spark, leaders.where("n > 1").select("band", "leader"), "leaders")
    buckets = keep(spark, banded.join(leaders, "band"), "buckets")
    wanted = nodes.select("node", "key.*").join(buckets.select("node").distinct(), "node", "left_semi")
    texts = keep(spark, docs.select(*row_key(), F.coalesce("text", F.lit("")).alias("text")).join(wanted, KEY)
                 .select("node", "text").dropDuplicates(["node"]), "texts")

    led = buckets.where(F.expr("node <> leader.node AND " + _fits("w", "leader.w")))
    first = keep(spark, led.select(F.col("leader.node").alias("a"), F.col("node").alias("b")).distinct(), "asked")
    links = keep(spark, verified(first, texts), "verified")

    led = _open(buckets, _labels(spark, links)).where(F.expr("class <> top.class AND " + _fits("w", "top.w")))
    second = led.select(F.least("top.node", "node").alias("a"), F.greatest("top.node", "node").alias("b")).distinct()
    second = keep(spark, second.join(first, ["a", "b"], "left_anti"), "asked")
    links = keep(spark, links.union(verified(second, texts)), "verified")

    opened = keep(spark, _open(buckets, _labels(spark, links)).select("node").distinct(), "open")
    rare = keep(spark, _rarest(spark, texts.join(opened, "node", "left_semi")), "rare")
    asked = first.union(second)
    for turn in range(TURNS):
        rows = _named(spark, rare, components(spark, links))
        pairs = keep(spark, _by_turn(spark, rows, turn).join(asked, ["a", "b"], "left_anti"), "asked")
        links, asked = keep(spark, links.union(verified(pairs, texts)), "verified"), asked.union(pairs)
    rest = _remaining(spark, components(spark, links), texts, rare).join(asked, ["a", "b"], "left_anti")
    return keep(spark, components(spark, links.union(verified(rest, texts))), "classes")


def _grouped(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Document rows with their nodes; per node the class, its smallest id, its first key and its rows."""
    rows = signed(spark, docs)
    classes = node_classes(spark, docs, rows)
    nodes = rows.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEY)).alias("first"))
    named = nodes.join(classes, "node", "left").select("node", F.coalesce("class", "node").alias("class"), "doc_id", "first")
    groups = named.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.min("first").alias("first"))
    return rows, named.select("node", "class").join(groups, "class")


def duplicate_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, class_id."""
    rows, nodes = _grouped(spark, docs)
    return rows.select("doc_id", "node").join(nodes.select("node", "class_id"), "node").select("doc_id", "class_id")


def distinct_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns: the one with the smallest id, of repeated rows one."""
    inputs = own_columns(docs, [])
    _, nodes = _grouped(spark, docs)
    stay = nodes.select("first.*").select(*KEY).distinct()
    keyed = docs.select(*row_key(), F.struct(*inputs).alias("_row"))
    return keyed.join(stay, KEY).dropDuplicates(KEY).select("_row.*")
