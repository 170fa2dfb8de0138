"""Language-model scores: interpolated modified Kneser-Ney n-grams in sorted hash arrays.

Counting, in Spark, a table a level:

1. Words of the training texts are counted; the sorted array of their 64-bit hashes is
   the vocabulary, and the place of a word in it is its id.
2. n-grams of ids are counted, combined per task before the shuffle.  From each merged
   table come the next lower level (how many words stand before a gram; grams that open
   a text keep their counts) and, per context, its total and how many words follow it
   once, twice, and more often.

Rows are *blocks*: sorted numpy columns of one range of hashes.  Hashes deal n-grams out
evenly, whatever their counts, and the number of ranges grows with the text
(``RANGE_BYTES``), so no task holds more than its share.  A hot n-gram is one row a task.

Storing: the task that merges a range writes it as one file of sorted hashes and counts,
the counts in the narrowest type that holds them.  The files lie in the folder of
``spark.checkpoint.dir``, written under another name and renamed, so a task that runs
twice does no harm.  Workers map the files into memory and look hashes up by binary
search, the questions of a batch sorted.  Where the shared folder is no mounted one
(an object store, say), a worker maps a nameless local copy instead.

Probability of a word after a context, from the highest level down:
(max(count - D(count), 0) + (D1 N1 + D2 N2 + D3 N3) p_lower) / total, the discounts D by
the closed form from the counts of counts; at the bottom the share of discounts is spread
evenly over all known words, the end, and one unknown word.

Defined results: a null text counts as empty, and has its end only; a null doc_id counts
as empty text in the split.  Repeated rows count and are scored each.  Without training
rows every probability is 1 (one unknown word).  An empty table gives no rows.  A text is
scored whole, in one task.  Further columns are ignored; ``doc_id`` and ``text`` are read
by name.  Words and grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.bagminhash import mix
from shoplens.llm.common import binaries, keep, text_bytes
from shoplens.plans.scratch import scratch_dir

ORDER, FOLDS, HELD_OUT = 2, 5, 1
#: Bytes of text for each range of hashes.
RANGE_BYTES = 1 << 24
#: n-grams (or words) that a task combines before it sends them on, and tokens it scores at a time.
HELD, SCORED = 1 << 21, 1 << 18
#: Files that a worker maps at a time.
MAPPED = 512

_Batches = Iterator[pa.RecordBatch]
_U = np.uint64
# Ids that no word has, the first id of a word, and the hash of the end of a text.
OPEN, UNKNOWN, FIRST_ID = 0, 1, 2
_END = _U(0x5BD1E9955BD1E995)
_BLOCK = "level int, kind int, range int, ids binary, counts binary"
#: What a block holds: counts of n-grams, or totals and follower counts of contexts.
GRAMS, CONTEXTS = 0, 1


# --- texts as word hashes ------------------------------------------------------------------------


def _codes() -> np.ndarray:
    code = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    code[0x41:0x5B] = code[0x61:0x7B]
    return code


_CODES = _codes()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by its end, and the number of tokens of each."""
    joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    inside = ~_SPACE[joined]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    words = np.zeros(len(starts), np.uint64)
    if len(starts):
        # letters are weighed by powers of an odd number, by their place in the word
        powers = np.ones(int(lengths.max()), np.uint64)
        powers[1:] = 0xD6E8FEB86659FD93
        powers = np.multiply.accumulate(powers)
        letters = _CODES[joined[inside]]
        first = np.cumsum(lengths) - lengths
        letters *= powers[np.arange(len(letters)) - np.repeat(first, lengths)]
        words = mix(np.add.reduceat(letters, first) ^ lengths.astype(np.uint64))
    of_text = np.searchsorted(ends, starts, "right")
    n = np.bincount(of_text, minlength=len(raws)) + 1
    tokens = np.full(len(words) + len(raws), _END)
    is_word = np.ones(len(tokens), bool)
    is_word[np.cumsum(n) - 1] = False
    tokens[is_word] = words
    return tokens, n


def texts_in(batches: _Batches, column: int, tokens: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of batches with about ``tokens`` tokens (a longer text is a piece of its own)."""
    for batch in batches:
        raws = binaries(batch.column(column))
        start, size = 0, 0
        for i, raw in enumerate(raws):
            size += len(raw)
            if size >= 6 * tokens or i == len(raws) - 1:
                yield batch.slice(start, i + 1 - start), raws[start:i + 1]
                start, size = i + 1, 0


# --- blocks --------------------------------------------------------------------------------------


def gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    """One hash per gram from its columns of ids."""
    h = np.full(len(ids[0]), len(ids), np.uint64)
    for column in ids:
        h = mix(h * _U(0x9E3779B97F4A7C15) + column.astype(np.uint64) + _U(1))
    return h


def merged(h: np.ndarray, ids: list[np.ndarray], counts: list[np.ndarray]):
    """Rows of equal hash as one, sorted by hash, their counts added."""
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], [x[order[first]] for x in ids], [np.add.reduceat(x[order], first) if len(h) else x for x in counts]


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def _pack(columns: list[np.ndarray]) -> bytes:
    parts = [_narrow(x) for x in columns]
    head = ",".join(f"{x.dtype.itemsize}:{len(x)}" for x in parts).encode()
    body = b"".join(x.tobytes() for x in parts)
    return b"%d %s %d " % (len(head), head, len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(raw: bytes) -> list[np.ndarray]:
    _, head, size, rest = raw.split(b" ", 3)
    body, at, out = pa.decompress(rest, int(size), codec="zstd", asbytes=True), 0, []
    for part in head.split(b",") if head else []:
        width, n = map(int, part.split(b":"))
        out.append(np.frombuffer(body, f"u{width}", n, at).astype(np.uint64))
        at += width * n
    return out


def _ranges(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _blocks(level: int, kind: int, h: np.ndarray, ids: list, counts: list, bits: int) -> _Batches:
    """Sorted rows as one block for each range."""
    edges = np.searchsorted(_ranges(h, bits), np.arange((1 << bits) + 1))
    for number in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[number], edges[number + 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([level], pa.int32()), pa.array([kind], pa.int32()), pa.array([number], pa.int32()),
             pa.array([_pack([x[part] for x in ids])], pa.binary()),
             pa.array([_pack([x[part] for x in counts])], pa.binary())],
            names=["level", "kind", "range", "ids", "counts"])


def _by_range(blocks: DataFrame, merge: Callable, schema: str) -> DataFrame:
    """``merge(level, kind, range, hashes, ids, counts)`` of each range, blocks of a range in one task."""
    def walk(batches: _Batches) -> _Batches:
        current, held = None, []

        def close() -> _Batches:
            columns = [[np.concatenate(x) for x in zip(*(_unpack(row[side]) for row in held))] for side in (0, 1)]
            ids, counts = columns
            # words come with their hash as their only id
            h = ids[0] if current[0] == 0 else gram_hash(ids)
            return merge(*current, *merged(h, ids, counts))

        for batch in batches:
            for level, kind, number, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (level, kind, number) != current:
                    if held:
                        yield from close()
                    current, held = (level, kind, number), []
                held.append((ids, counts))
        if held:
            yield from close()

    keys = ["level", "kind", "range"]
    return blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(walk, schema)


# --- files of sorted hashes ----------------------------------------------------------------------


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or not folder.startswith("file:") else
                                    "file://" + folder[len("file:"):])


def write_table(folder: str, name: str, h: np.ndarray, counts: list[np.ndarray]) -> None:
    """One file: a line that tells the columns, the hashes, the counts."""
    parts = [h, *map(_narrow, counts)]
    head = json.dumps([len(h), [x.dtype.itemsize for x in parts]]).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    files, path = _store(folder)
    files.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for part in [head, *(x.tobytes() for x in parts)]:
            out.write(part)
    files.move(own, f"{path}/{name}")


class Tables:
    """The files of a folder, mapped when first asked for."""

    def __init__(self, folder: str, bits: int) -> None:
        self.folder, self.bits, self.mapped = folder, bits, {}

    def _map(self, name: str) -> list[np.ndarray] | None:
        files, path = _store(self.folder)
        path = f"{path}/{name}"
        if files.get_file_info(path).type != pafs.FileType.File:
            return None
        if isinstance(files, pafs.LocalFileSystem):
            raw = np.asarray(np.memmap(path, np.uint8, "r"))
        else:
            copy = tempfile.TemporaryFile()
            with files.open_input_stream(path) as source:
                while chunk := source.read(1 << 22):
                    copy.write(chunk)
            copy.flush()
            raw = np.asarray(np.memmap(copy, np.uint8, "r"))
        end = int(np.flatnonzero(raw[:4096] == 0x0A)[0]) + 1
        (n, widths), columns = json.loads(bytes(raw[:end])), []
        for width in widths:
            columns.append(raw[end:end + n * width].view(f"u{width}"))
            end += n * width
        return columns

    def find(self, level: int, kind: int, h: np.ndarray, columns: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Place of each of the sorted hashes in its range's array (-1: not there), and its counts (0 then)."""
        place, counts = np.full(len(h), -1), [np.zeros(len(h), np.int64) for _ in range(columns)]
        numbers, starts = np.unique(_ranges(h, self.bits), return_index=True)
        for number, start, end in zip(numbers.tolist(), starts, [*starts[1:], len(h)]):
            name = f"{level}-{kind}-{number}"
            if name not in self.mapped:
                if len(self.mapped) >= MAPPED:
                    self.mapped.clear()
                self.mapped[name] = self._map(name)
            if (table := self.mapped[name]) is None:
                continue
            spot = np.minimum(np.searchsorted(table[0], h[start:end]), len(table[0]) - 1)
            there = np.flatnonzero(table[0][spot] == h[start:end])
            spot, at = spot[there], there + start
            place[at] = spot
            for out, column in zip(counts, table[1:]):
                out[at] = column[spot]
        return place, counts


def _distinct(h: np.ndarray, ask: Callable) -> list[np.ndarray]:
    """Answers of ``ask`` for every hash, asked once for equal ones."""
    unique, back = np.unique(h, return_inverse=True)
    return [x[back] for x in ask(unique)]


# --- the model -----------------------------------------------------------------------------------


class Model(NamedTuple):
    """Where the tables are, and what is known of all of them; a few numbers but ``offsets`` (one per range)."""

    folder: str
    bits: int
    order: int
    offsets: np.ndarray          # number of the first word of each range
    tokens: int                  # all training tokens
    words: int                   # distinct ones, the end included
    discounts: dict[int, list[float]]
    bottom: list[int]            # total of the lowest level, and its words seen once, twice, more often

    def ids(self, tables: Tables, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of tokens and their counts in training."""
        def ask(h: np.ndarray) -> list[np.ndarray]:
            place, (count,) = tables.find(0, GRAMS, h, 1)
            ids = np.where(place >= 0, place + self.offsets[_ranges(h, self.bits)] + FIRST_ID, UNKNOWN)
            return [ids.astype(np.uint64), count]

        return tuple(_distinct(tokens, ask))

    def probabilities(self, tables: Tables, grams: list[np.ndarray]) -> np.ndarray:
        """Of the last word of each gram (columns of ids) after the words before it."""
        p = np.full(len(grams[0]), 1.0 / (self.words + 1))
        for level in range(1, self.order + 1):
            ids = grams[self.order - level:]
            count, = _distinct(gram_hash(ids), lambda h: tables.find(level, GRAMS, h, 1)[1])
            if level == 1:
                total, *followers = (np.full(len(p), x, np.int64) for x in self.bottom)
            else:
                total, *followers = _distinct(gram_hash(ids[:-1]), lambda h: tables.find(level, CONTEXTS, h, 4)[1])
            d = np.array([0.0, *self.discounts[level]])
            spread = sum(d[i + 1] * followers[i] for i in range(3))
            seen = np.maximum(count - d[np.minimum(count, 3)], 0.0)
            p = np.where(total > 0, (seen + spread * p) / np.maximum(total, 1), p)
        return p


def opened(ids: np.ndarray, n: np.ndarray, order: int) -> list[np.ndarray]:
    """The gram that ends at each token, as columns; before the first word of a text stands ``OPEN``."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
    columns = [ids]
    for back in range(1, order):
        before = np.full(len(ids), OPEN, np.uint64)
        before[back:] = ids[:-back] if back < len(ids) else ids[:0]
        columns.insert(0, np.where(place >= back, before, _U(OPEN)))
    return columns


def discounts(counts: list[int]) -> list[float]:
    """D1, D2, D3+ from how many grams occur once to four times; 1/2, 1, 3/2 where one of these is missing.

    Each is kept between a tenth and its count, so no probability is zero.
    """
    n1, n2, n3, n4 = counts
    if min(counts) == 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.1), i + 1.0) for i, x in enumerate(found)]


def _combined(chunks: Iterator[tuple[np.ndarray, list[np.ndarray]]], level: int, bits: int) -> _Batches:
    """Blocks of what a task has counted, made whenever it holds ``HELD`` tokens."""
    held, size = [], 0

    def close() -> _Batches:
        h = np.concatenate([x for x, _ in held])
        ids = [np.concatenate(x) for x in zip(*(columns for _, columns in held))]
        return _blocks(level, GRAMS, *merged(h, ids, [np.ones(len(h), np.uint64)]), bits)

    for h, ids in chunks:
        held.append((h, ids))
        size += len(h)
        if size >= HELD:
            yield from close()
            held, size = [], 0
    if held:
        yield from close()


def count_words(spark: SparkSession, raw: DataFrame, folder: str, bits: int) -> tuple[np.ndarray, int, int]:
    """Writes the vocabulary; offsets of its ranges, training tokens, distinct ones."""
    def words(batches: _Batches) -> _Batches:
        def hashes():
            for _, raws in texts_in(batches, 0, SCORED):
                h, _ = word_hashes(raws)
                yield h, [h]
        return _combined(hashes(), 0, bits)

    def merge(level, kind, number, h, ids, counts) -> _Batches:
        write_table(folder, f"{level}-{kind}-{number}", h, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([len(h)]), pa.array([int(counts[0].sum())])], names=["range", "words", "tokens"])

    told = keep(spark, _by_range(raw.mapInArrow(words, _BLOCK), merge, "range int, words long, tokens long"), "words")
    sizes, tokens = np.zeros((1 << bits) + 1, np.int64), 0
    for r in told.collect():  # a row for each range
        sizes[r.range + 1] = r.words
        tokens += r.tokens
    return np.cumsum(sizes)[:-1], tokens, int(sizes.sum())


def _lower(level: int, folder: str, bits: int) -> Callable:
    """Writes the merged grams of a level, and makes the blocks of the next lower one, of contexts, and of counts of counts."""
    def merge(_, kind, number, h, ids, counts) -> _Batches:
        write_table(folder, f"{level}-{kind}-{number}", h, counts)
        count, = counts
        several = [np.array([(count == k).sum()], np.uint64) for k in (1, 2, 3, 4)] + [
            np.array([x], np.uint64) for x in (count.sum(), (count >= 3).sum())]
        yield from _blocks(level, -1, np.zeros(1, np.uint64), [np.zeros(1, np.uint64)], several, 0)
        if level > 1:
            one = [(count == 1), (count == 2), (count >= 3)]
            context = ids[:-1]
            yield from _blocks(level, CONTEXTS, *merged(
                gram_hash(context), context, [count, *(x.astype(np.uint64) for x in one)]), bits)
            rest = ids[1:]
            before = np.where(rest[0] == _U(OPEN), count, _U(1))
            yield from _blocks(level - 1, GRAMS, *merged(gram_hash(rest), rest, [before]), bits)

    return merge


def train(spark: SparkSession, texts: DataFrame, order: int = ORDER, range_bytes: int = RANGE_BYTES) -> Model:
    """The model of the texts (a column ``raw`` of UTF-8)."""
    folder = scratch_dir(spark, "llm-ngrams")
    size = texts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / range_bytes))))
    offsets, tokens, words = count_words(spark, texts, folder, bits)
    model = Model(folder, bits, order, offsets, tokens, words, {}, [0, 0, 0, 0])

    def grams(batches: _Batches) -> _Batches:
        tables = Tables(folder, bits)

        def chunks():
            for _, raws in texts_in(batches, 0, SCORED):
                h, n = word_hashes(raws)
                columns = opened(model.ids(tables, h)[0], n, order)
                yield gram_hash(columns), columns

        return _combined(chunks(), order, bits)

    blocks, made = texts.mapInArrow(grams, _BLOCK), []
    for level in range(order, 0, -1):
        made.append(keep(spark, _by_range(blocks, _lower(level, folder, bits), _BLOCK), f"level{level}"))
        several = np.zeros(6, np.int64)
        for r in made[-1].where("kind = -1").select("counts").collect():  # a row for each range
            several += np.array([int(x[0]) for x in _unpack(r.counts)])
        model.discounts[level] = discounts(several[:4].tolist())
        if level == 1:
            model.bottom[:] = [several[4], several[0], several[1], several[5]]
        blocks = made[-1].where(f"kind = {GRAMS}")

    def write(level, kind, number, h, _, counts) -> _Batches:
        write_table(folder, f"{level}-{kind}-{number}", h, counts)
        yield pa.RecordBatch.from_arrays([pa.array([len(h)])], names=["contexts"])

    for table in made[:-1]:
        keep(spark, _by_range(table.where(f"kind = {CONTEXTS}"), write, "contexts long"), "contexts")
    return model


# --- scores --------------------------------------------------------------------------------------


def remainder() -> Column:
    """By which documents are dealt into folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS


def scored(model: Model, docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score; the columns of ``docs`` but ``raw`` stay."""
    at = docs.columns.index("raw")
    names = [*(c for c in docs.columns if c != "raw"), "n_tokens", "n_known", "base_score", "score"]

    def score(batches: _Batches) -> _Batches:
        tables = Tables(model.folder, model.bits)
        base = math.log10(model.tokens + 0.5 * (model.words + 1))
        for batch, raws in texts_in(batches, at, SCORED):
            h, n = word_hashes(raws)
            ids, count = model.ids(tables, h)
            first = np.cumsum(n) - n
            logs = np.log10(model.probabilities(tables, opened(ids, n, model.order)))
            own = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(n.astype(np.int64)), pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
                 pa.array(np.add.reduceat(np.log10(count + 0.5) - base, first)), pa.array(np.add.reduceat(logs, first))],
                names=names)

    schema = docs.drop("raw").schema.add("n_tokens", "long").add("n_known", "long")
    return docs.mapInArrow(score, schema.add("base_score", "double").add("score", "double"))


def held_out_scores(spark: SparkSession, docs: DataFrame, order: int = ORDER, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Scores of all documents by a model of those not held out."""
    rows = docs.select("doc_id", (remainder() == HELD_OUT).alias("held_out"), text_bytes().alias("raw"))
    model = train(spark, rows.where("NOT held_out").select("raw"), order, range_bytes)
    return scored(model, rows).withColumn("train_tokens", F.lit(model.tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
