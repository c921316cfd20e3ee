"""Elias-Fano sequences over plain buffers, queried by vectorised select and successor search."""

from __future__ import annotations

import numpy as np

_BLOCK = 512  # bits of a directory entry
_WORDS = _BLOCK // 64
_ONE = np.uint64(1)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th set bit of each word."""
    word, rank, place = word.copy(), rank.astype(np.int64), np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        up = rank >= ones
        rank -= np.where(up, ones, 0)
        word = np.where(up, word >> np.uint64(width), word)
        place += width * up
    return place


class EliasFano:
    """A non-decreasing sequence of n integers below 2**63: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * _BLOCK - ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        low = np.zeros((n * bits >> 6) + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = -(-((top >> bits) + n + 2) // _BLOCK) * _BLOCK
        flags = np.zeros(size, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        per = np.bitwise_count(high).reshape(-1, _WORDS).sum(1, dtype=np.int64)
        return cls(n, bits, low, high, np.concatenate(([0], np.cumsum(per)))[:-1].astype(np.int64))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones]

    @classmethod
    def from_arrays(cls, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, high, ones)

    def _select(self, k: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        block = np.searchsorted(directory, k, side="right") - 1
        rank = k - directory[block]
        words = self.high[block[:, None] * _WORDS + np.arange(_WORDS)]
        if flip:
            words = ~words
        upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        at = (upto <= rank[:, None]).sum(1)
        row = np.arange(len(k))
        before = np.where(at > 0, upto[row, np.maximum(at - 1, 0)], 0)
        return block * _BLOCK + at * 64 + _select_in_word(words[row, at], rank - before)

    def _low(self, j: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(j), np.uint64)
        at = j.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        high = np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, _ONE)), np.uint64(0))
        return ((self.low[word] >> shift) | high) & np.uint64((1 << self.low_bits) - 1)

    def get(self, j: np.ndarray) -> np.ndarray:
        """Values at places j."""
        j = np.asarray(j, np.int64)
        high = (self._select(j, self.ones, False) - j).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(j)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x the place of the first value at or above it (n if none), and whether it is x."""
        x = np.asarray(x, np.uint64)
        place, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        if not self.n:
            return place, same
        top = int(self.get(np.array([self.n - 1]))[0])
        inside = np.flatnonzero(x <= np.uint64(top))
        y = x[inside]
        high, low = (y >> np.uint64(self.low_bits)).astype(np.int64), y & np.uint64((1 << self.low_bits) - 1)
        bit = np.zeros(len(y), np.int64)
        after = high > 0
        bit[after] = self._select(high[after] - 1, self.zeros, True) + 1
        j = bit - high
        open_ = np.arange(len(y))
        for _ in range(2):  # values with the same high part, one or two as a rule
            b, k = bit[open_], j[open_]
            there = (self.high[b >> 6] >> (b & 63).astype(np.uint64)) & _ONE == 1
            value = self._low(np.minimum(k, self.n - 1))
            smaller = there & (value < low[open_])
            same[inside[open_[there & (value == low[open_])]]] = True
            open_ = open_[smaller]
            bit[open_] += 1
            j[open_] += 1
        if len(open_):  # where they are many, by halves
            below, above = j[open_], self._select(high[open_], self.zeros, True) - high[open_]
            end = above.copy()
            while (wide := np.flatnonzero(below < above)).size:
                middle = (below[wide] + above[wide]) >> 1
                less = self._low(middle) < low[open_[wide]]
                below[wide] = np.where(less, middle + 1, below[wide])
                above[wide] = np.where(less, above[wide], middle)
            j[open_] = below
            hit = below < end
            same[inside[open_[hit]]] = self._low(below[hit]) == low[open_[hit]]
        place[inside] = j
        return place, same


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one buffer of 8-byte aligned parts."""
    kinds = {"u1": 0, "u8": 1, "i8": 2, "u4": 3}
    head, parts = [len(arrays)], []
    for a in arrays:
        head += [kinds[a.dtype.str[1:]], len(a)]
        raw = a.tobytes()
        parts.append(raw + b"\0" * (-len(raw) % 8))
    return np.array(head, np.int64).tobytes() + b"".join(parts)


def unpack(buffer: np.ndarray) -> list[np.ndarray]:
    """Views of the arrays in a buffer of bytes."""
    kinds = (np.uint8, np.uint64, np.int64, np.uint32)
    count = int(buffer[:8].view(np.int64)[0])
    head = buffer[8 : 8 + 16 * count].view(np.int64).reshape(-1, 2)
    out, at = [], 8 + 16 * count
    for kind, n in head.tolist():
        size = n * np.dtype(kinds[kind]).itemsize
        out.append(buffer[at : at + size].view(kinds[kind]))
        at += size + -size % 8
    return out
