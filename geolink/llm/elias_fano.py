"""Elias-Fano sequences on numpy arrays, which may be memory-mapped; queries are vectorised.

A monotone sequence of n values below u takes about 2 + log2(u / n) bits for each: the low bits of the
values in one packed array, and the high bits in unary in a bit vector, where value i sets bit
``(value >> low) + i``. The directories are the ones and the zeros before each word of 64 bits.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_ONE = np.uint64(1)
# One bit in each byte: the lowest, and the highest.
_LOWEST, _HIGHEST = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


def _select_tables() -> np.ndarray:
    """Position of the k-th one in each byte, k from 0; 8 where there is none."""
    out = np.full((256, 8), 8, np.int64)
    for byte in range(256):
        for k, bit in enumerate(b for b in range(8) if byte >> b & 1):
            out[byte, k] = bit
    return out


_SELECT = _select_tables()


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th one (from 0) in each word, by the ones up to each of its bytes."""
    k = k.astype(np.uint64)
    ones = word - ((word >> _ONE) & np.uint64(0x5555555555555555))
    two = np.uint64(0x3333333333333333)
    ones = (ones & two) + ((ones >> np.uint64(2)) & two)
    ones = ((ones + (ones >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _LOWEST
    # The highest bit of a byte stays where up to there are no more than k ones.
    passed = ((k * _LOWEST | _HIGHEST) - ones) & _HIGHEST
    at = np.bitwise_count(passed).astype(np.uint64) << np.uint64(3)
    before = ((ones << np.uint64(8)) >> at) & np.uint64(255)
    byte = (word >> at) & np.uint64(255)
    return at.astype(np.int64) + _SELECT[byte.astype(np.int64), (k - before).astype(np.int64)]


class EliasFano(NamedTuple):
    """A monotone sequence; ``low`` packs ``bits`` bits of each value, ``high`` is the unary part."""

    size: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray

    @staticmethod
    def build(values: np.ndarray) -> EliasFano:
        """From values of type uint64, which do not fall."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max((top // max(n, 1)).bit_length() - 1, 0) if n else 0
        low = np.zeros((n * bits + 63) // 64 + 1, np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            start = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        high = np.zeros(int(place[-1] >> np.uint64(6)) + 2 if n else 1, np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), _ONE << (place & np.uint64(63)))
        ones = np.zeros(len(high) + 1, np.int64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        zeros = np.arange(len(ones)) * 64 - ones
        small = np.int32 if len(high) < 1 << 25 else np.int64
        return EliasFano(n, bits, low, high, ones.astype(small), zeros.astype(small))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones, "zeros": self.zeros}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        start = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
        value = self.low[word] >> shift
        over = shift + np.uint64(self.bits) > np.uint64(64)
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values by position, by the place of the i-th one."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - self.ones[word])
        return (place.astype(np.uint64) - i.astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def _before(self, zeros: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``zeros``: the ones before the zeros-th zero."""
        # The wanted zero is number zeros - 1.
        beyond = zeros.astype(np.uint64) > np.uint64(self.zeros[-1])
        k = np.where(beyond, 0, zeros).astype(np.int64) - 1
        wanted = np.maximum(k, 0)
        word = np.searchsorted(self.zeros, wanted.astype(self.zeros.dtype), side="right") - 1
        place = _select_in_word(~self.high[word], wanted - self.zeros[word])
        ones = word * 64 + place - np.maximum(k, 0)
        return np.where(zeros == 0, 0, np.where(beyond, self.size, ones))

    def find(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position of each value among the positions from ``begin`` to ``end``; -1 if absent.

        The successor search goes to the values with the same high part, clipped to the range, and
        halves those by their low parts.
        """
        high = values >> np.uint64(self.bits)
        low = values & np.uint64((1 << self.bits) - 1)
        first = np.maximum(self._before(high), begin)
        stop = np.minimum(self._before(high + _ONE), end)
        left, right = first.copy(), np.maximum(stop, first)
        while True:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                break
            middle = (left[open_] + right[open_]) // 2
            smaller = self._low(middle) < low[open_]
            left[open_] = np.where(smaller, middle + 1, left[open_])
            right[open_] = np.where(smaller, right[open_], middle)
        hit = left < stop
        found = np.full(len(values), -1, np.int64)
        at = np.flatnonzero(hit)
        same = self._low(left[at]) == low[at]
        found[at[same]] = left[at[same]]
        return found
