"""Elias-Fano sequences in numpy: compact, monotone, searched and read many places at once."""

from __future__ import annotations

import numpy as np

#: Values whose low bits are packed at once.
BLOCK = 1 << 18


class EliasFano:
    """A non-decreasing sequence of 64-bit values in about 2 + log2(universe / length) bits each.

    What is stored: the low bits of the values, packed, and the high bits as a row of unary
    numbers. Both may lie in a mapped file. The row is unpacked once, on first use, to where
    the values of each high part begin, or to where each value's bit is.
    """

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        n = len(values)
        self.n = n
        top = int(values[-1]) if n else 0
        self.shift = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        self.size = n + (int(high[-1]) if n else 0) + 1
        row = np.zeros(self.size, bool)
        row[high + np.arange(n)] = True
        self.high = np.packbits(row, bitorder="little")
        self.low = self._packed(values) if self.shift else np.zeros(2, np.uint64)
        self._begins: np.ndarray | None = None
        self._places: np.ndarray | None = None

    def _packed(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(-(-self.n * self.shift // 64) + 2, np.uint64)
        for begin in range(0, self.n, BLOCK):
            low = values[begin : begin + BLOCK] & np.uint64((1 << self.shift) - 1)
            at = np.arange(begin, begin + len(low), dtype=np.uint64) * np.uint64(self.shift)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(out, word, low << bit)
            over = np.flatnonzero(bit + np.uint64(self.shift) > 64)
            np.bitwise_or.at(out, word[over] + 1, low[over] >> (np.uint64(64) - bit[over]))
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {"high": self.high, "low": self.low}

    def _row(self) -> np.ndarray:
        return np.unpackbits(self.high, count=self.size, bitorder="little").view(bool)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(at), np.uint64)
        place = at.astype(np.uint64) * np.uint64(self.shift)
        word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        # Shifted in two steps, as a shift by 64 is no shift.
        value = (self.low[word] >> bit) | ((self.low[word + 1] << (np.uint64(63) - bit)) << np.uint64(1))
        return value & np.uint64((1 << self.shift) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The values at the places ``at``: the place of a one gives its high part."""
        if self._places is None:
            self._places = np.flatnonzero(self._row())
        return ((self._places[at] - at).astype(np.uint64) << np.uint64(self.shift)) | self._low(at)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where the sequence has none: the successor, by halving,
        among the values that share the high part, if it is the value itself."""
        if not self.n:
            return np.full(len(values), -1, np.int64)
        if self._begins is None:
            zeros = np.flatnonzero(~self._row())
            begins = np.concatenate([[0], zeros - np.arange(len(zeros)), [self.n]])
            self._begins = begins.astype(np.uint32 if self.n < 1 << 32 else np.int64)
        values = values.astype(np.uint64, copy=False)
        high = np.minimum(values >> np.uint64(self.shift), np.uint64(len(self._begins) - 1)).astype(np.int64)
        at = self._begins[high].astype(np.int64)
        stop = self._begins[np.minimum(high + 1, len(self._begins) - 1)].astype(np.int64)
        wanted = values & np.uint64((1 << self.shift) - 1)
        end = stop.copy()
        on = np.flatnonzero(at < end)
        while len(on):
            low, up = at[on], end[on]
            middle = (low + up) >> 1
            below = self._low(middle) < wanted[on]
            low, up = np.where(below, middle + 1, low), np.where(below, up, middle)
            at[on], end[on] = low, up
            on = on[low < up]
        out = np.full(len(values), -1, np.int64)
        near = np.flatnonzero(at < stop)
        hit = near[self._low(at[near]) == wanted[near]]
        out[hit] = at[hit]
        return out
