"""Spelling variants: words one inserted, deleted or replaced code point apart, by k-d trees over letter counts.

One edit changes the letter counts of a word little: a replacement takes one from one
letter and gives one to another (L1 distance two), an insertion gives one to one letter
(L1 distance one).  So the words of each length are points in a space of letter counts,
and the near words of a word lie in a small box around it:

1. Words are counted in Spark, combined per task before the shuffle.
2. The top of one k-d tree per length is fitted on a bounded sample of the words
   (``SAMPLE``); its leaves are *cells*.  The sample moves the planes only: every word
   is indexed, and any planes give the same result.
3. A word is a point of its own cell.  It asks the other cells that its box reaches:
   those of its length with a higher number (so each pair is met once), and those of
   the next length.
4. A task builds the rest of the tree of a cell and runs the range searches of all that
   ask it, pruned by the boxes: at most one letter more, and one less where lengths agree.
5. Points found are compared letter by letter.
6. Each word's form is the largest of its near words; chains of forms are followed by
   pointer doubling.  A form is ten times as frequent as the word, so chains are short.

Defined results: null and empty texts have no words; a null doc_id counts as empty text
in the hash; texts and words of any length are taken whole.  Repeated rows count each.
Ties between near words of one count go to the smallest in code-point order.  An empty
table gives no rows.  Further columns are ignored; ``doc_id`` and ``text`` are read by
name.  Words of one length and the same letters cannot be near and are never paired.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import binaries, keep, pieces, text_bytes

MIN_LENGTH, MIN_COUNT, DAMAGE, RATIO = 7, 2, 31, 10
#: Words that the planes of the cells are fitted on, and words of a cell if the sample is like all words.
SAMPLE, CELL_WORDS = 1 << 16, 1 << 15
#: Points in a leaf of the tree inside a cell.
LEAF = 16
#: Words that a task counts before it sends them on.
HELD = 200_000

_Batches = Iterator[pa.RecordBatch]

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _words_of(doc_id: object, raw: bytes, run: re.Pattern) -> Counter:
    """The damaged words of one text with their counts."""
    found: Counter = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(run.findall(raw.translate(_LOWER).decode(errors="replace"))).items():
        h = zlib.crc32(word.encode(), prefix)
        if h % DAMAGE == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= MIN_LENGTH:
            found[word] += n
    return found


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words found ``min_count`` times or more."""
    def count(batches: _Batches) -> _Batches:
        run, held = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in pieces(batches):
            for doc_id, raw in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                for word, n in _words_of(doc_id, raw, run).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield rows()
        if held:
            yield rows()

    counted = docs.select("doc_id", text_bytes().alias("raw")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- letter counts -------------------------------------------------------------------------------

#: Words are held as Latin-1, a byte a letter: a-z and U+00C0 to U+00FF.
_PLACE = np.zeros(256, np.int64)
_PLACE[0x61:0x7B], _PLACE[0xC0:0x100] = np.arange(26), np.arange(26, 90)
LETTERS = 90


class Words:
    """Some words, their letter counts, and a bit per letter for odd counts; made per length."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        owner = np.repeat(np.arange(len(words)), self.length)
        kind = _PLACE[self.letters]
        self.counts = np.zeros((len(words), LETTERS), np.uint32)
        np.add.at(self.counts, (owner, kind), 1)
        self.odd = np.zeros(len(words), np.uint64)
        np.bitwise_xor.at(self.odd, owner, np.uint64(1) << (kind % 64).astype(np.uint64))

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        """(word, place) letters of words of one length."""
        return self.letters[self.start[at][:, None] + np.arange(length)]


def split_plane(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter whose counts vary most, and the count at which to part the points; None if all are equal."""
    spread = counts.var(0)
    letter = int(spread.argmax())
    if spread[letter] == 0:
        return None
    column = counts[:, letter]
    return letter, min(int(np.floor(column.mean())), int(column.max()) - 1)


def reached(queries: np.ndarray, at: np.ndarray, letter: int, most: int, less: np.ndarray, more: np.ndarray):
    """Which queries reach either side of a plane, with what they may still have ``less`` and ``more``.

    The box of a side lies at most one count beyond the plane or not at all; a second plane
    of the same letter on that side would lie two beyond, so each is charged once.
    """
    count = queries[at, letter].astype(np.int64)
    low = (count <= most) | ((count == most + 1) & (less > 0))
    high = (count > most) | ((count == most) & (more > 0))
    return ((at[low], (less - (count > most))[low], more[low]), (at[high], less[high], (more - (count <= most))[high]))


# --- the top of the trees: cells -----------------------------------------------------------------


def fit_cells(words: list[str], leaf: int) -> dict[int, list]:
    """Per length a tree of nodes [letter, most, low, high], leaves [cell]; from at most ``SAMPLE`` words."""
    trees: dict[int, list] = {}
    cells = 0

    def grow(counts: np.ndarray, nodes: list) -> int:
        nonlocal cells
        mine = len(nodes)
        plane = split_plane(counts) if len(counts) > leaf else None
        nodes.append(None)
        if plane is None:
            nodes[mine] = (cells,)
            cells += 1
        else:
            low = counts[:, plane[0]] <= plane[1]
            nodes[mine] = (*plane, grow(counts[low], nodes), grow(counts[~low], nodes))
        return mine

    for length in sorted(set(map(len, words))):
        some = Words([w for w in words if len(w) == length])
        grow(some.counts, trees.setdefault(length, []))
    return trees


def _descend(tree: list, counts: np.ndarray, less: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, cell) for all cells that the box of a query reaches."""
    n = len(counts)
    stack = [(0, (np.arange(n), np.full(n, less), np.full(n, more)))]
    queries, cells = [], []
    while stack:
        node, (at, down, up) = stack.pop()
        if not len(at):
            continue
        if len(tree[node]) == 1:
            queries.append(at)
            cells.append(np.full(len(at), tree[node][0]))
        else:
            letter, most, low, high = tree[node]
            below, above = reached(counts, at, letter, most, down, up)
            stack += [(low, below), (high, above)]
    return np.concatenate(queries), np.concatenate(cells)


#: What a row is in its cell: a point, or a question by a word of the same or the next smaller length.
POINT, SAME, SHORTER = 0, 1, 2


def routed(words: DataFrame, trees: dict[int, list]) -> DataFrame:
    """cell, role, word, n: every word as a point of its cell and as a question to the others that it reaches.

    Lengths that the sample has no word of are cells of their own, numbered below zero.
    """
    def route(batches: _Batches) -> _Batches:
        for batch in pieces(batches, 4096):
            some = Words(batch.column(0).to_pylist())
            found = []
            for length in np.unique(some.length).tolist():
                at = np.flatnonzero(some.length == length)
                counts = some.counts[at]
                own = np.full(len(at), -length)
                if length in trees:
                    query, cell = _descend(trees[length], counts, 0, 0)
                    own[query] = cell
                    query, cell = _descend(trees[length], counts, 1, 1)
                    ask = cell > own[query]
                    found.append((at[query[ask]], cell[ask], SAME))
                found.append((at, own, POINT))
                if length + 1 in trees:
                    query, cell = _descend(trees[length + 1], counts, 0, 1)
                    found.append((at[query], cell, SHORTER))
                else:
                    found.append((at, np.full(len(at), -length - 1), SHORTER))
            at = np.concatenate([x[0] for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x[1] for x in found])),
                 pa.array(np.concatenate([np.full(len(x[0]), x[2], np.int32) for x in found])),
                 batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))],
                names=["cell", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(route, "cell long, role int, word string, n long")


# --- inside a cell -------------------------------------------------------------------------------


def grow_tree(counts: np.ndarray) -> list:
    """Nodes [letter, most, low, high] and leaves [points]; a leaf is small or holds one vector of counts."""
    nodes: list = [None]
    stack = [(0, np.arange(len(counts)))]
    while stack:
        node, at = stack.pop()
        plane = split_plane(counts[at]) if len(at) > LEAF else None
        if plane is None:
            nodes[node] = (at,)
            continue
        low = counts[at, plane[0]] <= plane[1]
        nodes[node] = (*plane, len(nodes), len(nodes) + 1)
        stack += [(len(nodes), at[low]), (len(nodes) + 1, at[~low])]
        nodes += [None, None]
    return nodes


def candidates(tree: list, points: Words, queries: Words, less: int, more: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) in the boxes, after a look at the bits for odd counts; in blocks."""
    n, bits = len(queries.words), less + more
    stack = [(0, (np.arange(n), np.full(n, less), np.full(n, more)))]
    held_q, held_p, held = [], [], 0
    while stack:
        node, (at, down, up) = stack.pop()
        if not len(at):
            continue
        if len(tree[node]) == 4:
            letter, most, low, high = tree[node]
            below, above = reached(queries.counts, at, letter, most, down, up)
            stack += [(low, below), (high, above)]
            continue
        leaf = tree[node][0]
        step = max(1, (1 << 21) // len(leaf))
        for start in range(0, len(at), step):
            some = at[start:start + step]
            q, p = np.nonzero(np.bitwise_count(queries.odd[some][:, None] ^ points.odd[leaf][None, :]) <= bits)
            held_q.append(some[q])
            held_p.append(leaf[p])
            held += len(q)
            if held >= 1 << 19:
                yield np.concatenate(held_q), np.concatenate(held_p)
                held_q, held_p, held = [], [], 0
    if held:
        yield np.concatenate(held_q), np.concatenate(held_p)


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of b is that of a with one letter more: what they share from either end covers a."""
    length = a.shape[1]
    head = np.cumprod(a == b[:, :length], 1, dtype=np.int32).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], 1, dtype=np.int32).sum(1)
    return head + tail >= length


def near_in_cell(points: list[str], same: list[str], shorter: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(question, point, role) numbers of near words; points ask each other once."""
    if not points:
        return
    here, length = Words(points), len(points[0])
    tree = grow_tree(here.counts)
    for role, asked, less, more in ((POINT, here, 1, 1), (SAME, Words(same), 1, 1), (SHORTER, Words(shorter), 0, 1)):
        if not asked.words:
            continue
        size = length - (role == SHORTER)
        alike = inserted if role == SHORTER else replaced
        step = max(1, (1 << 24) // length)
        for q, p in candidates(tree, here, asked, less, more):
            if role == POINT:
                q, p = q[q < p], p[q < p]
            for start in range(0, len(q), step):
                x, y = q[start:start + step], p[start:start + step]
                hit = alike(asked.rows(x, size), here.rows(y, length))
                yield x[hit], y[hit], role


def near_pairs(spark: SparkSession, words: DataFrame, sample: int = SAMPLE, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, near, near_n: every word with every near word, in both directions."""
    total = words.count()
    every = max(1, -(-total // sample))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word")  # about ``sample`` words
    trees = fit_cells([r.word for r in some.limit(2 * sample).collect()], max(LEAF, cell_words // every))

    def search(batches: _Batches) -> _Batches:
        current, rows = None, []

        def found() -> _Batches:
            cell = pa.Table.from_batches(rows).combine_chunks()
            role = cell.column("role").to_numpy()
            at = [np.flatnonzero(role == r) for r in (POINT, SAME, SHORTER)]
            text, n = cell.column("word"), cell.column("n")
            words_of = [text.take(pa.array(x)).to_pylist() for x in at]
            for q, p, kind in near_in_cell(*words_of):
                a, b = pa.array(at[kind][q]), pa.array(at[POINT][p])
                for x, y in ((a, b), (b, a)):
                    yield from pa.Table.from_arrays(
                        [text.take(x), text.take(y), n.take(y)], names=["word", "near", "near_n"]).to_batches(20_000)

        for batch in batches:  # rows come cell after cell
            cell = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)) if len(cell) else []
            for start, end in zip(edges, [*edges[1:], len(cell)]):
                if cell[start] != current:
                    if rows:
                        yield from found()
                    current, rows = cell[start], []
                rows.append(batch.slice(start, end - start))
        if rows:
            yield from found()

    dealt = routed(words, trees).repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(search, "word string, near string, near_n long")


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word, root for words that have a form: the last of the chain, by pointer doubling."""
    at = keep(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = keep(spark, at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO,
             sample: int = SAMPLE, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word."""
    words = keep(spark, word_counts(docs, min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(spark, words, sample, cell_words).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best"))
    named = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n"))
    named = keep(spark, named, "forms")
    ends = roots(spark, named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
