"""Token counts that follow edits.

A document is cut into leaves of whole pre-tokens, about ``LEAF`` characters each, and a
segment tree holds characters and tokens of every subtree.  An edit finds its leaves by
descending over characters; only these leaves, and a neighbour where the edit comes
within a character of the cut, are encoded again, and the sums above them updated.

A cut is a single space between two visible characters.  A pre-token never reaches over
it, whatever stands further away, so a leaf's tokens depend on the leaf alone as long as
the characters beside its cuts stay.

State of a document: its text and, per leaf, characters and tokens.  Rows of state and
edits meet sorted by document; a task holds one document and one edit at a time.

Defined results: a null or empty text has no tokens; edits are applied by ``seq``, then
start, end and text, positions in the text as it then is and cut to its ends; an end
before the start counts as the start; a null replacement is empty; edits without a
document id, or with one that no document has, do nothing; of rows that repeat an id the
one with the largest text is edited.  Special token strings are ordinary text.  A text of
any length is counted whole; with its edits, in order, it is one task's by nature.  No
documents give no rows.  Further columns of documents and edits are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import pieces
from shoplens.llm.tokens import encoder

LEAF = 256


def cuts(text: str, size: int = LEAF) -> list[int]:
    """Lengths of the leaves of a text."""
    lengths, begin, n = [], 0, len(text)
    while n - begin > size:
        at = text.find(" ", begin + size)
        while at != -1 and (at + 1 >= n or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at == -1:
            break
        lengths.append(at - begin)
        begin = at
    if n > begin:
        lengths.append(n - begin)
    return lengths


class Tree:
    """A document with sums of characters and tokens over its leaves; node i has the children 2i and 2i + 1."""

    def __init__(self, text: str, chars: list[int] | None = None, tokens: list[int] | None = None,
                 folder: str | None = None) -> None:
        self._count = encoder(folder).count
        self.text, self.encoded = text, 0
        if chars is None or tokens is None:
            chars = cuts(text)
            tokens = self._tokens(text, chars)
        self._plant(chars, tokens)

    def _tokens(self, text: str, lengths: list[int]) -> list[int]:
        counts, begin = [], 0
        for length in lengths:
            counts.append(self._count(text[begin:begin + length]))
            begin += length
        self.encoded += begin
        return counts

    def _plant(self, chars: list[int], tokens: list[int]) -> None:
        self._leaves = 1
        while self._leaves < len(chars):
            self._leaves *= 2
        pad = [0] * (self._leaves - len(chars))
        self._chars, self._sum = [0] * self._leaves + chars + pad, [0] * self._leaves + tokens + pad
        for node in range(self._leaves - 1, 0, -1):
            self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
            self._sum[node] = self._sum[2 * node] + self._sum[2 * node + 1]

    @property
    def total(self) -> int:
        return self._sum[1]

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        used = [i for i in range(self._leaves, 2 * self._leaves) if self._chars[i]]
        return [self._chars[i] for i in used], [self._sum[i] for i in used]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins."""
        node, begin = 1, 0
        while node < self._leaves:
            node *= 2
            if place - begin >= self._chars[node] and self._chars[node + 1]:
                begin += self._chars[node]
                node += 1
        return node, begin

    def edit(self, start: int, end: int, new: str) -> None:
        n = len(self.text)
        start = min(max(start, 0), n)
        end = min(max(end, start), n)
        # two characters before the edit and one after it belong to leaves that stay whole
        first, begin = self._leaf_at(max(start - 2, 0))
        last, last_begin = self._leaf_at(min(end + 1, max(n - 1, 0)))
        stop = last_begin + self._chars[last]
        region = self.text[begin:start] + new + self.text[end:stop]
        self.text = self.text[:start] + new + self.text[end:]
        lengths, slots = cuts(region), last - first + 1
        if len(lengths) > slots:
            if sum(lengths[slots - 1:]) > 8 * LEAF:  # no room: all leaves move, but only the region is encoded
                before = range(self._leaves, first)
                after = range(last + 1, 2 * self._leaves)
                own = self._tokens(region, lengths)
                chars = [self._chars[i] for i in before] + lengths + [self._chars[i] for i in after]
                tokens = [self._sum[i] for i in before] + own + [self._sum[i] for i in after]
                used = [i for i, length in enumerate(chars) if length]
                self._plant([chars[i] for i in used], [tokens[i] for i in used])
                return
            lengths = lengths[:slots - 1] + [sum(lengths[slots - 1:])]
        own = self._tokens(region, lengths)
        lengths, own = ([*x, *[0] * (slots - len(x))] for x in (lengths, own))
        changed = set()
        for i, node in enumerate(range(first, last + 1)):
            self._chars[node], self._sum[node] = lengths[i], own[i]
            changed.add(node // 2)
        while changed and changed != {0}:
            for node in changed:
                self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
                self._sum[node] = self._sum[2 * node] + self._sum[2 * node + 1]
            changed = {node // 2 for node in changed} - {0}


def build(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """State of documents: doc_id, text, leaf_chars, leaf_tokens."""
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            leaves = [Tree(text, folder=folder).leaves for text in batch.column(1).to_pylist()]
            columns = zip(*leaves) if leaves else [[], []]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.list_(pa.int32())) for c in columns)],
                names=["doc_id", "text", "leaf_chars", "leaf_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*rows.schema.fields, T.StructField("leaf_chars", ints), T.StructField("leaf_tokens", ints)])
    return rows.mapInArrow(plant, schema)


def apply_edits(state: DataFrame, edits: DataFrame, folder: str | None = None) -> DataFrame:
    """New state with n_tokens_before, n_edits, n_tokens and reencoded (characters).

    ``edits``: doc_id, seq, start, end, replacement.
    """
    rows = state.select("doc_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("seq"),
                        F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"),
                        "text", "leaf_chars", "leaf_tokens")
    nothing = F.lit(None).cast("array<int>")
    changes = edits.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast(state.schema["doc_id"].dataType).alias("doc_id"), F.lit(1).alias("kind"),
        *(F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("seq", "start", "end")),
        F.coalesce("replacement", F.lit("")).alias("text"), nothing.alias("leaf_chars"), nothing.alias("leaf_tokens"))
    # documents without an id are dealt out by their text
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    together = rows.unionByName(changes).repartition(deal).sortWithinPartitions(
        "doc_id", "kind", "seq", "start", "end", "text")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, before, edited, done = None, 0, 0, []

        def close() -> None:
            if current is not None:
                doc_id, tree = current
                done.append((doc_id, tree.text, *tree.leaves, before, edited, tree.total, tree.encoded))

        def emitted() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        kinds = None
        for batch in pieces(batches):
            kinds = [batch.schema.field(0).type, pa.string(), *[pa.list_(pa.int32())] * 2, *[pa.int64()] * 4]
            for doc_id, kind, _, start, end, text, chars, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    close()
                    current, edited = (doc_id, Tree(text, chars, tokens, folder)), 0
                    before = current[1].total
                elif current is not None and current[0] == doc_id:
                    current[1].edit(start, end, text)
                    edited += 1
            if done:
                yield emitted()
        close()
        if done:
            yield emitted()

    schema = state.select("doc_id", "text", "leaf_chars", "leaf_tokens").schema
    for name in ("n_tokens_before", "n_edits", "n_tokens", "reencoded"):
        schema = schema.add(name, "long")
    return together.mapInArrow(follow, schema)


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits of every document: a replacement, a deletion and an insertion, at places given by its id."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    edit = F.explode(F.array(*(
        F.struct(F.lit(seq).cast("long").alias("seq"),
                 F.pmod(F.xxhash64("doc_id", F.lit(seq)), size + 1).alias("start"), F.lit(length).alias("length"),
                 F.lit(text).alias("replacement"))
        for seq, (length, text) in enumerate([(5, "other words"), (12, ""), (0, " added\n\nlines, 12 ")]))))
    return docs.select("doc_id", edit.alias("e")).select(
        "doc_id", "e.seq", "e.start", (F.col("e.start") + F.col("e.length")).alias("end"), "e.replacement")


def recounted(docs: DataFrame, edits: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_chars, n_tokens_before, n_edits, n_tokens, reencoded."""
    after = apply_edits(build(docs, folder), edits, folder)
    return after.select("doc_id", F.length("text").cast("long").alias("n_chars"), "n_tokens_before", "n_edits",
                        "n_tokens", "reencoded", F.sha2("text", 256).alias("text_sha256"))
