"""Weighted-Jaccard signatures of word shingles (BagMinHash), many texts at a time.

The weight of a shingle is how often it occurs.  Weights are cut at 1, 2, 4, 8, ...;
each stretch [0, 1), [1, 2), [2, 4), ... of each shingle has a Poisson process in
time whose rate is its length.  A point of it has a time, a slot of the signature and
a weight inside the stretch, all from hashes of shingle, stretch and number of the
point, so every text that holds the shingle sees the same points.  A text takes the
points whose weight lies below its own count (of a stretch it covers in part, some),
and each slot keeps the earliest.  Two texts agree in a slot with the probability
of their weighted Jaccard similarity: sum of smaller counts over sum of larger.

Points come in the order of their times, so a process is left as soon as it is past
the time at which all slots of its text are filled: about one point for each shingle.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
SLOTS = 128

_U = np.uint64
# Multipliers of a 64-bit finalizer, and odd steps.
_M1, _M2, _STEP, _BASE = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _byte_codes() -> np.ndarray:
    """A number per byte, 0 for what is no part of a word; A-Z like a-z."""
    code = np.zeros(256, np.uint64)
    parts = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    code[parts] = mix(np.array(parts, np.uint64) * _STEP)
    code[0x41:0x5B] = code[0x61:0x7B]
    return code


_CODES = _byte_codes()
_WORD_BYTE = _CODES > 0

_table = bytearray(b" " * 256)
for _b in np.flatnonzero(_WORD_BYTE).tolist():
    _table[_b] = _b + 32 if 0x41 <= _b < 0x5B else _b
_table = bytes(_table)


def normal(raw: bytes) -> bytes:
    """The words of a text, joined by blanks."""
    return b" ".join(raw.translate(_table).split())


def shingles(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of every different shingle, ordered by text and hash.

    A text of fewer words has one shingle of all of them, one without words none.
    """
    joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends_of_texts = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    inside = _WORD_BYTE[joined]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(starts):
        return none
    letters = _CODES[joined[inside]]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.ones(int(lengths.max()), np.uint64)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    words = mix(np.add.reduceat(letters * powers[place], first) ^ (lengths.astype(np.uint64) * _STEP))
    text = np.searchsorted(ends_of_texts, starts, "right")

    n = len(words)
    hashes = np.zeros(n, np.uint64)
    for j in range(SHINGLE):  # shorter texts end early: words of the next text are masked out
        part, m = np.zeros(n, np.uint64), max(0, n - j)
        part[:m] = np.where(text[j:] == text[:m], words[j:], _U(0))
        hashes = mix(hashes * _BASE + part + _U(j + 1))
    whole = np.ones(n, bool)
    whole[max(0, n - SHINGLE + 1):] = False
    whole[:max(0, n - SHINGLE + 1)] = text[SHINGLE - 1:] == text[:max(0, n - SHINGLE + 1)]
    opens = np.ones(n, bool)
    opens[1:] = text[1:] != text[:-1]
    whole |= opens  # the first place of a short text stands for all of it

    text, hashes = text[whole], hashes[whole]
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(at, append=len(text))


def signatures(n_texts: int, text: np.ndarray, element: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Signatures of all texts (rows); a row of a text without elements stays infinite."""
    out = np.full((n_texts, SLOTS), np.inf)
    if not len(text):
        return out
    # stretches of each element: number j up to the one that holds its count
    stretch = np.frexp(count - 0.5)[1].clip(0) + 1  # 1 -> 1 stretch, 2 -> 2, 3..4 -> 3, ...
    rows = np.repeat(np.arange(len(text)), stretch)
    level = np.arange(len(rows)) - np.repeat(np.cumsum(stretch) - stretch, stretch)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.where(level > 0, low, 1.0)
    share = np.minimum(1.0, (count[rows] - low) / rate)
    seed = mix(element[rows] + level.astype(np.uint64) * _M2)
    doc = text[rows]
    weight = np.bincount(text, count, n_texts)
    with np.errstate(divide="ignore"):
        limit = SLOTS / weight * (np.log(SLOTS) + 2)
    step = SLOTS / np.maximum(weight, 1e-9) * 2

    def draw(at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = mix(seed[at] + number * _STEP)
        wait = -np.log1p(-((bits >> _U(11)).astype(np.float64) * 2.0 ** -53)) / rate[at]
        return bits, wait

    everything = np.arange(len(rows))
    number = np.zeros(len(rows), np.uint64)
    bits, time = draw(everything, number)
    live = everything
    while True:
        live = live[time[live] < limit[doc[live]]]
        while len(live):
            drawn = mix(bits[live] ^ _M1)
            slot = (drawn & _U(SLOTS - 1)).astype(np.int64)
            takes = share[live] >= 1
            part = np.flatnonzero(~takes)
            if len(part):
                takes[part] = (drawn[part] >> _U(11)).astype(np.float64) * 2.0 ** -53 < share[live[part]]
            np.minimum.at(out, (doc[live[takes]], slot[takes]), time[live[takes]])
            number[live] += _U(1)
            more, wait = draw(live, number[live])
            bits[live] = more
            time[live] += wait
            live = live[time[live] < limit[doc[live]]]
        open_ = np.isinf(out.max(1)) & (weight > 0)
        if not open_.any():
            return out
        limit[open_] += step[open_]
        live = everything[open_[doc]]


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], tenths: int = 8) -> bool:
    """Whether sum of smaller counts over sum of larger is at least ``tenths`` / 10."""
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at], b[1][bt]).sum())
    return 10 * shared >= tenths * (int(a[1].sum()) + int(b[1].sum()) - shared)
