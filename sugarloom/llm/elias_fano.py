"""Elias-Fano coded ascending numbers over numpy arrays, for batches of queries.

n numbers below u take about 2 + log2(u / n) bits each: the low bits packed, the high bits as a bit
vector with one at (high + place). All queries are array operations; sorted queries read memory in order.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_ONES = U(0x0101010101010101)
_BYTE_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _BYTE_SELECT[_b, : len(_at)] = _at


def select_in_word(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The bit place of the one number r (from 0) of each word."""
    s = words - ((words >> U(1)) & U(0x5555555555555555))
    s = (s & U(0x3333333333333333)) + ((s >> U(2)) & U(0x3333333333333333))
    s = ((s + (s >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * _ONES  # byte i: ones up to byte i
    # bytes whose sum is at most r lie before the one that is looked for
    over = (((r.astype(U) * _ONES) | U(0x8080808080808080)) - s) & U(0x8080808080808080)
    byte = np.bitwise_count(over).astype(U)
    shift = byte * U(8)
    before = np.where(byte > 0, (s << U(8)) >> shift & U(255), U(0))
    rest = (r.astype(U) - before).astype(np.int64)
    value = (words >> shift & U(255)).astype(np.int64)
    return (shift + _BYTE_SELECT[value, rest]).astype(np.int64)


def build(values: np.ndarray) -> dict[str, np.ndarray]:
    """The parts of the code of ascending uint64 values."""
    n = len(values)
    last = int(values[-1]) if n else 0
    low = max(0, int(np.log2((last + 1) / n))) if n and last >= n else 0
    place = np.arange(n, dtype=np.int64)
    words = np.zeros((n * low >> 6) + 2, U)
    if low:
        bits = values & U((1 << low) - 1)
        at, off = place * low >> 6, (place * low & 63).astype(U)
        np.bitwise_or.at(words, at, bits << off)
        spill = np.flatnonzero(off + U(low) > U(64))
        np.bitwise_or.at(words, at[spill] + 1, bits[spill] >> (U(64) - off[spill]))
    high = (values >> U(low)).astype(np.int64) + place
    size = (last >> low) + n + 1  # and one more zero at the end
    upper = np.zeros((size >> 6) + 1, U)
    np.bitwise_or.at(upper, high >> 6, U(1) << (high & 63).astype(U))
    ones = np.zeros(len(upper) + 1, np.int64)
    np.cumsum(np.bitwise_count(upper), out=ones[1:])
    return {"meta": np.array([n, low, last], U), "low": words, "upper": upper, "ones": ones.astype(np.uint32)}


class EliasFano:
    """Queries on the parts that build() gives, in memory or mapped from a file."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.low, self.last = (int(x) for x in parts["meta"])
        self.words, self.upper, self.ones = parts["low"], parts["upper"], parts["ones"]
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def _select(self, r: np.ndarray, sums: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(sums, r, "right") - 1
        bits = self.upper[word]
        return word * 64 + select_in_word(~bits if flip else bits, r - sums[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), U)
        bit = i * self.low
        at, off = bit >> 6, (bit & 63).astype(U)
        over = self.words[at + 1] << ((U(64) - off) & U(63))
        return ((self.words[at] >> off) | np.where(off > 0, over, U(0))) & U((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.empty(0, U)
        high = self._select(i, self.ones, False) - i
        return high.astype(U) << U(self.low) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each x the place of the first value of at least x (n if there is none), and whether it equals x."""
        x = np.asarray(x, U)
        place, equal = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        inside = np.flatnonzero(x <= U(self.last)) if self.n else np.empty(0, np.int64)
        if not len(inside):
            return place, equal
        own = x[inside]
        high = (own >> U(self.low)).astype(np.int64)
        want = own & U((1 << self.low) - 1) if self.low else np.zeros(len(own), U)
        hi = self._select(high, self.zeros, True) - high
        lo = np.zeros(len(own), np.int64)
        some = np.flatnonzero(high > 0)
        lo[some] = self._select(high[some] - 1, self.zeros, True) - (high[some] - 1)
        end = hi.copy()
        left = np.flatnonzero(lo < hi)
        while len(left):
            mid = (lo[left] + hi[left]) >> 1
            less = self._low(mid) < want[left]
            lo[left] = np.where(less, mid + 1, lo[left])
            hi[left] = np.where(less, hi[left], mid)
            left = left[lo[left] < hi[left]]
        hit = lo < end
        same = np.zeros(len(own), bool)
        same[hit] = self._low(lo[hit]) == want[hit]
        place[inside], equal[inside] = lo, same
        return place, equal
