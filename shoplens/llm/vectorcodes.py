"""Vector code compression: product codes learned by member-resident Lloyd rounds.

Every vector is cut into ``PARTS`` equal parts of integers; each part position has a
codebook of ``ENTRIES`` entries.  The parts are a table whose rows live with the owner
(position, entry, salt) of the entry they belong to:

1. All parts get their nearest entry where they are read, and go to their owners once.
2. An owner sums its resident members; the sums of the salts meet per entry and give the
   next codebook (``positions x entries`` rows at most, whatever the input).
3. Residents look for their entry again.  Those that keep it stay in place, without a
   shuffle; only those that change it migrate to their new owner.
4. After the last round the vectors are coded in one pass over the input with the final
   codebooks, so no part has to find its vector again.

The salt deals the members of an entry out among ``salts`` owners, so an entry that holds
a third of all parts (copies of one vector) is no single task.  All arithmetic is on
integers; sums are exact decimals, so the result does not depend on the partitioning.

Defined results: rows whose vector is null, empty, or holds a null or a non-finite
component are dropped.  Repeated rows are coded each; a repeated vec_id seeds the
codebooks once, by its smallest vector; a null vec_id never seeds unless all are null,
in which case there are no codebooks and no rows.  The number of components is that of
the first seed; rows of another number are dropped too.  If it is no multiple of the
number of parts, the last parts are filled with zeros.  Components beyond 2**24 after
scaling count as that bound, so that an error fits a long.  Fewer than ``ENTRIES`` vectors
give as many entries.  An empty table gives no rows.  Ties go to the lower index.
Further columns are ignored; ``vec_id``, ``embedding`` and ``label`` are read by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import keep

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components beyond this count as it.
BOUND = 1 << 24
#: Members of one owner if all parts of a position had one entry.
OWNER_ROWS = 1 << 16
MIN_SALTS = 16

_Batches = Iterator[pa.RecordBatch]


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles, label of the rows that have a whole, finite vector."""
    vector = F.col("embedding").cast("array<double>")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", vector.alias("embedding"), "label")
    return kept.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(whole)


def whole_parts(flat: np.ndarray, n: int, parts: int) -> np.ndarray:
    """(vector, part, place) integers of ``n`` vectors laid end to end."""
    scaled = np.clip(np.floor(flat.reshape(n, -1) * SCALE), -BOUND, BOUND).astype(np.int64)
    width = -(-scaled.shape[1] // parts)
    out = np.zeros((n, parts * width), np.int64)
    out[:, :scaled.shape[1]] = scaled
    return out.reshape(n, parts, width)


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, ties to the lower, and the squared distance; in steps that bound memory."""
    best, error = np.empty(len(members), np.int64), np.empty(len(members), np.int64)
    step = max(1, (1 << 22) // max(1, book.size))
    for at in range(0, len(members), step):
        gap = members[at:at + step, None, :] - book[None, :, :]
        distance = np.einsum("ijk,ijk->ij", gap, gap)
        best[at:at + step] = distance.argmin(1)
        error[at:at + step] = distance.min(1)
    return best, error


def seeds(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """(position, entry, place): the parts of the vectors with the smallest ids; None without any."""
    first = (vectors.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
             .orderBy("vec_id").limit(entries).collect())  # entries rows
    if not first:
        return None
    width = len(first[0].embedding)
    rows = [r.embedding for r in first if len(r.embedding) == width]
    return whole_parts(np.array(rows).ravel(), len(rows), parts).transpose(1, 0, 2).copy()


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _members(position: np.ndarray, entry: np.ndarray, salt: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
    return pa.RecordBatch.from_arrays(
        [pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(salt.astype(np.int32)), lists],
        names=["position", "entry", "salt", "part"])


_MEMBER = "position int, entry int, salt int, part array<long>"


def settled(vectors: DataFrame, book: np.ndarray, salts: int) -> DataFrame:
    """Every part with its owner, where the vectors are read."""
    parts = book.shape[0]

    def assign(batches: _Batches) -> _Batches:
        seen = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                some = batch.slice(start, 1024).column(0)
                cut = whole_parts(_flat(some), len(some), parts)
                salt = (np.arange(len(some)) + seen) % salts
                seen += len(some)
                for position in range(parts):
                    entry, _ = nearest(cut[:, position], book[position])
                    yield _members(np.full(len(some), position), entry, salt, cut[:, position])

    return vectors.select("embedding").mapInArrow(assign, _MEMBER)


def reassigned(members: DataFrame, book: np.ndarray) -> DataFrame:
    """The residents with the entry they have now and the one they belong to next."""
    def assign(batches: _Batches) -> _Batches:
        for batch in batches:
            position = batch.column(0).to_numpy()
            values = _flat(batch.column(3)).reshape(batch.num_rows, -1)
            entry = np.empty(batch.num_rows, np.int64)
            for one in np.unique(position):
                at = np.flatnonzero(position == one)
                entry[at], _ = nearest(values[at], book[one])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(entry.astype(np.int32))], names=[*batch.schema.names, "next"])

    return members.mapInArrow(assign, _MEMBER + ", next int")


def updated(members: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after the owners have summed their residents; an entry without members stays."""
    width = book.shape[2]
    sums = members.groupBy("position", "entry").agg(
        F.count("*").alias("n"),
        *(F.sum(F.col("part")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))
    new = book.copy()
    for row in sums.collect():  # positions x entries rows at most
        new[row.position, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    return new


def migrated(spark: SparkSession, members: DataFrame, book: np.ndarray) -> DataFrame:
    """The residents after a round: who keeps the entry stays where it is, the others are shuffled to their new owner."""
    moved = keep(spark, reassigned(members, book), "reassigned")
    stay = moved.where("next = entry").select("position", "entry", "salt", "part")
    leave = moved.where("next <> entry").select("position", F.col("next").alias("entry"), "salt", "part")
    return stay.unionByName(leave.repartition("position", "entry", "salt"))


def codebooks(spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS) -> np.ndarray | None:
    """(position, entry, place) after ``rounds`` rounds over :func:`finite` vectors; None without any."""
    book = seeds(vectors, parts, entries)
    if book is None or not rounds:
        return book
    width = len(vectors.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding").first().embedding)
    vectors = vectors.where(F.size("embedding") == width)
    salts = max(MIN_SALTS, -(-vectors.count() // OWNER_ROWS))
    members = settled(vectors, book, salts).repartition("position", "entry", "salt")
    for turn in range(rounds):
        members = keep(spark, members, "members")
        book = updated(members, book)
        if turn + 1 < rounds:
            members = migrated(spark, members, book)
    return book


def coded(vectors: DataFrame, book: np.ndarray, width: int) -> DataFrame:
    """vec_id, label, code, error of every vector of ``width`` components."""
    parts = book.shape[0]

    def encode(batches: _Batches) -> _Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                some = batch.slice(start, 1024)
                cut = whole_parts(_flat(some.column(1)), some.num_rows, parts)
                codes, error = np.empty((some.num_rows, parts), np.int64), np.zeros(some.num_rows, np.int64)
                for position in range(parts):
                    codes[:, position], distance = nearest(cut[:, position], book[position])
                    error += distance
                text = ["".join(f"{x:02x}" for x in row) for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(text, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    kept = vectors.where(F.size("embedding") == width).select("vec_id", "embedding", "label")
    return kept.mapInArrow(encode, kept.drop("embedding").schema.add("code", "string").add("error", "long"))


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components, in decimal, by position, entry and place."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every whole vector."""
    whole = finite(vectors)
    book = codebooks(spark, whole, parts, entries, rounds)
    if book is None:
        none = whole.where(F.lit(False)).select("vec_id")
        return none.withColumns({"code": F.lit(""), "error": F.lit(0).cast("long"),
                                 "label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    width = len(whole.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding").first().embedding)
    rows = keep(spark, coded(whole, book, width), "coded")
    # written first: a join of two read tables is one whose hot labels Spark splits
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = keep(spark, totals.withColumnRenamed("label", "_label"), "label-errors")
    return rows.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"))
