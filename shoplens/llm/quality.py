"""Quality rules as a short-circuit cascade.

A rule rejects a document by its text.  Cost and selectivity of every rule are
estimated on a sample of documents, the selectivity on what the rules before it leave;
the rules then run in the order of rejections per second, and the first that rejects a
document ends its cascade.  The verdict is "no rule rejects", which does not depend on
the order; the order only saves time.

The sample is the one bounded thing here (``SAMPLE_ROWS``); it sets the order and
nothing else.  All rules see whole texts of all documents.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged alike; null ids stay; further columns are passed through, but
those named like ``ADDED`` are replaced.  A text of any length is judged whole, in one
task.  An empty table gives no rows, and an order by name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import binaries, own_columns, pieces, text_bytes

ADDED = ["_kept", "_ran"]
SAMPLE_ROWS = 2000  # documents that the order of the rules is estimated on

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


class Text:
    """A text and what several rules need of it, each worked out at most once."""

    def __init__(self, raw: bytes) -> None:
        self.raw = raw
        self._words: list[bytes] | None = None
        self._repeated: int | None = None
        self._lines: tuple[int, int] | None = None

    @property
    def words(self) -> list[bytes]:
        if self._words is None:
            self._words = self.raw.split()
        return self._words

    @property
    def word_chars(self) -> int:
        solid = self.raw.translate(None, _SPACES)
        return len(solid) - len(solid.translate(None, bytes(range(0x80)) + bytes(range(0xC0, 0x100))))

    @property
    def symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @property
    def lines(self) -> tuple[int, int]:
        """Lines with a word, and those of them that equal an earlier line."""
        if self._lines is None:
            full = [line for line in self.raw.split(b"\n") if line.strip()]
            self._lines = len(full), len(full) - len(set(full))
        return self._lines

    @property
    def repeated(self) -> int:
        """Words inside windows of three words that occur twice or more."""
        if self._repeated is None:
            self._repeated = _repeated_words(self.words)
        return self._repeated


def _repeated_words(words: list[bytes]) -> int:
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    if len(index) == n:
        return 0
    kinds = len(index)
    if kinds < 1 << 20:
        codes = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    else:  # three ids need more than 63 bits: number the pairs first
        _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
        codes = pairs[:-1] * np.int64(kinds) + ids[2:]
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def _few_words(t: Text) -> bool:
    return len(t.words) < 50


def _repetitive(t: Text) -> bool:
    return 100 * t.repeated > 50 * len(t.words)


def _symbolic(t: Text) -> bool:
    return 10 * t.symbols > len(t.words)


def _repeated_lines(t: Text) -> bool:
    lines, dup = t.lines
    return 10 * dup > 7 * lines


def _word_length(t: Text) -> bool:
    return not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)


def _shouting(t: Text) -> bool:
    upper = len(t.raw) - len(t.raw.translate(None, _UPPER))
    return 2 * upper > t.word_chars


# Base rules of the contract, then those that the cascade adds.
BASE_RULES: dict[str, Callable[[Text], bool]] = {"few_words": _few_words, "repetitive": _repetitive}
RULES: dict[str, Callable[[Text], bool]] = {
    **BASE_RULES, "symbolic": _symbolic, "repeated_lines": _repeated_lines,
    "word_length": _word_length, "shouting": _shouting,
}


def estimate(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Of about ``rows`` random documents, what each rule says (``hits``, in the order of ``RULES``) and its seconds."""
    share = min(1.0, 1.2 * rows / max(docs.count(), 1))
    sample = docs.select(text_bytes().alias("raw")).sample(share, seed=3).limit(rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hits, seconds = [], []
            for raw in binaries(batch.column(0)):
                said, spent = [], []
                for rule in RULES.values():
                    fresh = Text(raw)
                    begin = time.perf_counter()
                    said.append(bool(rule(fresh)))
                    spent.append(time.perf_counter() - begin)
                hits.append(said)
                seconds.append(spent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, pa.list_(pa.bool_())), pa.array(seconds, pa.list_(pa.float64()))], names=["hits", "seconds"])

    return sample.mapInArrow(measure, "hits array<boolean>, seconds array<double>")


def by_rejections_per_second(hits: np.ndarray, seconds: np.ndarray) -> list[str]:
    """The rules, best first; each is measured on what those before it leave, and names break ties."""
    left, names, order = np.ones(len(hits), bool), list(RULES), []
    cost = seconds.sum(0) / max(len(hits), 1)
    while len(order) < len(names):
        rest = [k for k, name in enumerate(names) if name not in order]
        best = min(rest, key=lambda k: (-hits[left, k].sum() / max(cost[k], 1e-9), names[k]))
        order.append(names[best])
        left &= ~hits[:, best]
    return order


def plan(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[str]:
    """The order in which the cascade asks its rules."""
    measured = estimate(docs, rows).collect()  # ``rows`` rows at most
    shape = (len(measured), len(RULES))
    return by_rejections_per_second(np.array([r.hits for r in measured], bool).reshape(shape),
                                    np.array([r.seconds for r in measured], float).reshape(shape))


def verdict(text: Text, rules: list[Callable[[Text], bool]]) -> tuple[bool, int]:
    """Whether no rule rejects the text, and how many were asked: the first that rejects it ends the cascade."""
    for number, rule in enumerate(rules, 1):
        if rule(text):
            return False, number
    return True, len(rules)


def cascade(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Appends ``_kept`` and ``_ran``, how many rules ran before the verdict; columns of these names are replaced."""
    names = order or plan(docs)
    inputs = own_columns(docs, ADDED)
    rows = docs.select(F.struct(*inputs).alias("row"), text_bytes().alias("raw"))
    fields = [f.name for f in rows.schema["row"].dataType.fields]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [RULES[name] for name in names]
        for batch in pieces(batches):
            judged = [verdict(Text(raw), rules) for raw in binaries(batch.column(1))]
            kept, ran = [k for k, _ in judged], [n for _, n in judged]
            yield pa.RecordBatch.from_arrays(
                [*batch.column(0).flatten(), pa.array(kept, pa.bool_()), pa.array(ran, pa.int32())],
                names=[*fields, *ADDED])

    schema = docs.select(*inputs).withColumns({"_kept": F.lit(True), "_ran": F.lit(0)}).schema
    return rows.mapInArrow(judge, schema)


def accepted(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The documents that no rule rejects."""
    return cascade(docs, order).where("_kept").drop(*ADDED)


def report(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Per document the base counts, the base verdict and the verdict of the cascade, which includes the base rules."""
    names = order or plan(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [RULES[name] for name in names]
        for batch in pieces(batches):
            rows = []
            for raw in binaries(batch.column(1)):
                t = Text(raw)
                kept, _ = verdict(t, rules)  # before the counts: what it works out serves them too
                base = not kept and any(rule(t) for rule in BASE_RULES.values())
                rows.append((len(t.words), t.word_chars, t.symbols, t.lines[1], t.repeated, base, kept))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=REPORT)

    schema = docs.select("doc_id").schema
    for name in REPORT[1:6]:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")
    return docs.select("doc_id", text_bytes().alias("_raw")).mapInArrow(count, schema)


REPORT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
