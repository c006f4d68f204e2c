"""Winnowed anchors and window hashes of many texts at once, vectorised.

Sequences are hashed by a polynomial over 64-bit word hashes with wrapping arithmetic, from prefix
sums, so that the hash of any run of words costs the same.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

# Two odd bases (fixed values; any odd numbers of 64 bits do).
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    """Word hashes of a batch, one after the other; document d has ``starts[d]:starts[d + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray


class Spans(NamedTuple):
    """Runs of window starts that choose the same anchor: ``first`` to ``last`` within ``doc``."""

    doc: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    first: np.ndarray
    last: np.ndarray


def split_words(text: bytes | None) -> list[bytes]:
    """Words between the six ASCII white-space characters, unchanged; none for null."""
    return text.split() if text else []


def hash_words(texts: list[bytes | None]) -> Words:
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    starts = [0]
    for text in texts:
        hashes += [digest(w) for w in split_words(text)]
        starts.append(len(hashes))
    return Words(np.array(hashes, np.uint64), np.array(starts, np.int64))


def _powers_of(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < size:
        size = 1 << max(16, size.bit_length())
        both = []
        for b in (base, pow(base, -1, 2**64)):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        known = _powers[base] = (both[0], both[1])
    return known


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(BASES[0])
    return x ^ (x >> np.uint64(29))


class SequenceHash:
    """Hashes of runs of words of a batch."""

    def __init__(self, hashes: np.ndarray, base: int):
        self.powers, self.inverse = _powers_of(base, len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[: len(hashes)], out=self.sums[1:])

    def runs(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.inverse[start])


def _first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first minimum of each window of ``width`` values."""
    count = len(values) - width + 1
    low, at, span = values, np.arange(len(values), dtype=np.int64), 1

    def joined(a, at_a, b, at_b):
        return np.minimum(a, b), np.where(b < a, at_b, at_a)

    while span * 2 <= width:
        low, at = joined(low[:-span], at[:-span], low[span:], at[span:])
        span *= 2
    shift = width - span
    return joined(low[:count], at[:count], low[shift : shift + count], at[shift : shift + count])[1]


def spans(found: Words, window: int, gram: int) -> Spans:
    """Anchors of each text, with the window starts that choose them and a hash of their content.

    A window chooses the first smallest hash among its runs of ``gram`` words. That depends on the
    words of the window alone: equal windows have equal anchors at equal offsets, wherever they are.
    The content is all words that the windows of the anchor cover, and the anchor's place in them.
    """
    hashes, starts = found
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return Spans(none, none.view(np.uint64), none.view(np.uint64), none, none)
    hasher = SequenceHash(hashes, BASES[0])
    grams = np.arange(len(hashes) - gram + 1)
    values = hasher.runs(grams, grams + gram)
    at = _first_minima(values, window - gram + 1)
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(at)]
    begins = np.arange(len(at))
    valid = np.flatnonzero(begins + window <= starts[doc + 1])
    if not len(valid):
        return Spans(none, none.view(np.uint64), none.view(np.uint64), none, none)
    at, doc = at[valid], doc[valid]
    edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
    first = valid[edge]
    last = valid[np.r_[edge[1:] - 1, len(valid) - 1]]
    place, doc = at[edge], doc[edge]
    content = hasher.runs(first, last + window)
    shape = (place - first) * 4096 + (last - first)
    content = _mixed(content ^ (shape.astype(np.uint64) * np.uint64(BASES[1])))
    return Spans(doc, values[place], content, first - starts[doc], last - starts[doc])
