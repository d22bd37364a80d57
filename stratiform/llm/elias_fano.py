"""Elias-Fano coding of non-decreasing sequences as numpy arrays: low bits packed, high bits in unary.

``get`` reads any positions, ``next_geq`` finds the first position whose value is at least x; both work on whole
arrays of queries. All parts are views of one uint64 array, so a level can be memory-mapped.
"""

from __future__ import annotations

import numpy as np

_HEAD = 8
#: Position of the k-th set bit of each byte (8 where there is none).
_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _i in enumerate([i for i in range(8) if _b >> i & 1]):
        _SELECT[_b, _k] = _i


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th (from 0) set bit of each word."""
    octets = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    ends = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int64)
    octet = (ends <= k[:, None]).sum(axis=1)
    rows = np.arange(len(words))
    before = np.where(octet > 0, ends[rows, np.maximum(octet - 1, 0)], 0)
    return 8 * octet + _SELECT[octets[rows, octet], k - before]


class EliasFano:
    """Reads a sequence from the array that ``encode`` made."""

    def __init__(self, data: np.ndarray):
        self.n, self.low_bits, self.universe, low, high, ones = (int(x) for x in data[:6])
        at = _HEAD
        self.low, at = data[at : at + low], at + low
        self.high, at = data[at : at + high], at + high
        half = -(-(high + 1) // 2)
        self.ones = data[at : at + half].view(np.uint32)[: high + 1]
        self.size = at + half

    @staticmethod
    def encode(values: np.ndarray, universe: int | None = None) -> np.ndarray:
        """``values``: non-decreasing, below ``universe``; under 2**32 of them."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        universe = int(universe if universe is not None else (int(values[-1]) + 1 if n else 1))
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            # several values may fall into one word: the parts of a word don't overlap, so adding is or-ing
            np.add.at(low, word, part << shift)
            over = shift + np.uint64(bits) > 64
            np.add.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        tops = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        length = (universe >> bits) + n + 2
        high = np.zeros(length // 64 + 1, np.uint64)
        np.add.at(high, tops >> 6, np.uint64(1) << (tops & 63).astype(np.uint64))
        ones = np.zeros(-(-(len(high) + 1) // 2) * 2, np.uint32)
        ones[1 : len(high) + 1] = np.cumsum(np.bitwise_count(high))
        head = np.zeros(_HEAD, np.uint64)
        head[:6] = n, bits, min(universe, 2**64 - 1), len(low), len(high), 0
        return np.concatenate([head, low, high, ones.view(np.uint64)])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        out = self.low[word] >> shift
        spill = np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return (out | spill) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions i."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - self.ones[word])
        return (place - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def _after_zeros(self, k: np.ndarray) -> np.ndarray:
        """How many values have high bits below k: the ones before the k-th zero (from 1; 0 for k = 0)."""
        words = np.arange(len(self.high) + 1, dtype=np.int64) * 64
        zeros = words - self.ones
        want = np.maximum(k - 1, 0)
        word = np.minimum(np.searchsorted(zeros, want, side="right") - 1, len(self.high) - 1)
        place = word * 64 + _select_in_word(~self.high[word], want - zeros[word])
        return np.where(k > 0, place - want, 0)

    def next_geq(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first position whose value is at least x, and that value; position n and value 2**64 - 1 if there is none."""
        x = np.asarray(x, np.uint64)
        tops = np.minimum(x >> np.uint64(self.low_bits), np.uint64(self.universe >> self.low_bits)).astype(np.int64)
        at, end = self._after_zeros(tops), self._after_zeros(tops + 1)
        # values from `at` to `end` have x's high bits: halve that range by the low bits
        last, low = end.copy(), x & np.uint64((1 << self.low_bits) - 1)
        left = np.flatnonzero(at < end)
        while len(left):
            middle = (at[left] + end[left]) // 2
            small = self._low(middle) < low[left]
            at[left[small]] = middle[small] + 1
            end[left[~small]] = middle[~small]
            left = left[at[left] < end[left]]
        value = np.full(len(x), 0xFFFFFFFFFFFFFFFF, np.uint64)
        same, after = np.flatnonzero(at < last), np.flatnonzero((at == last) & (at < self.n))
        value[same] = tops[same].astype(np.uint64) << np.uint64(self.low_bits) | self._low(at[same])
        value[after] = self.get(at[after])
        beyond = np.flatnonzero(value < x)  # x lies above the universe
        at[beyond], value[beyond] = self.n, 0xFFFFFFFFFFFFFFFF
        return at, value
