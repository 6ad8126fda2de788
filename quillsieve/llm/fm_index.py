"""A compressed full-text index over numbers: Burrows-Wheeler transform in a wavelet tree.

The tree is shaped by a prefix code whose lengths follow the symbols' frequencies, so its
bits are close to the entropy of the text. All queries of a batch go through the tree
together; a step of the backward search is a few array operations per level.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A row of bits that tells the ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(packed) // 8 + 2, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self._words = words
        self._before = np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & below)


class WaveletTree:
    """Occurrences of a symbol before any place of a sequence of numbers 0 .. symbols-1."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        counts = np.bincount(sequence, minlength=symbols)
        # a code of length ceil(log2(n / count)) exists for all symbols at once (Kraft)
        length = np.ceil(np.log2(max(len(sequence), 1) / np.maximum(counts, 1)) - 1e-12).astype(np.int64)
        order = np.argsort(length, kind="stable")
        deepest = int(length.max(initial=0))
        step = np.int64(1) << (deepest - length[order])
        code = np.empty(symbols, np.int64)
        code[order] = (np.cumsum(step) - step) >> (deepest - length[order])
        self._length, self._code = length, code
        self._levels: list[tuple[Bits, np.ndarray, np.ndarray]] = []
        here = sequence[length[sequence] > 0]
        for level in range(deepest):
            prefix = code[here] >> (length[here] - level)
            inner = length > level
            start = np.zeros(symbols, np.int64)
            start[inner] = np.searchsorted(prefix, code[inner] >> (length[inner] - level))
            bit = (code[here] >> (length[here] - 1 - level)) & 1
            bits = Bits(bit.astype(bool))
            self._levels.append((bits, start, bits.ones(start)))
            here = here[np.argsort((prefix << 1) | bit, kind="stable")]
            here = here[length[here] > level + 1]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        out = place.copy()
        live = np.arange(len(symbol))
        for level, (bits, start, ones_before) in enumerate(self._levels):
            live = live[self._length[symbol[live]] > level]
            if not len(live):
                break
            own, at = symbol[live], out[live]
            ones = bits.ones(start[own] + at) - ones_before[own]
            right = (self._code[own] >> (self._length[own] - 1 - level)) & 1 == 1
            out[live] = np.where(right, ones, at - ones)
        return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes, sorted by their first ``depth`` numbers at least."""
    n, done = len(text), 1
    order = np.argsort(text, kind="stable")
    while True:
        key = text[order] if done == 1 else key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        if done >= depth or (n and rank[order[-1]] == n - 1) or not n:
            return order
        key = rank * (n + 1)
        key[: n - done] += rank[done:] + 1
        order = np.argsort(key, kind="stable")
        done *= 2


class FMIndex:
    """Backward search for patterns of up to ``depth`` numbers in a text of numbers 0 .. symbols-1."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.size = len(text)
        order = suffix_order(text, depth)
        self._tree = WaveletTree(text[order - 1], symbols)  # the last number stands before the first
        self._first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the patterns with one more number in front."""
        before = self._tree.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        first = self._first[symbol]
        return first + before[: len(symbol)], first + before[len(symbol) :]

    def matching_statistics(self, stream: np.ndarray, ends: np.ndarray, limit: int, times: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, low, high) for each place ``ends`` of a stream: the longest string of up to
        ``limit`` numbers that ends there (its last number included) and stands at least
        ``times`` times in the text, and its suffix interval."""
        symbol = stream[ends]
        low, high = self._first[symbol], self._first[symbol + 1]
        found = high - low >= times
        length = found.astype(np.int64)
        low, high = np.where(found, low, 0), np.where(found, high, self.size)
        live = np.flatnonzero(found)
        for step in range(1, limit):
            live = live[ends[live] >= step]
            if not len(live):
                break
            lo, hi = self.extend(stream[ends[live] - step], low[live], high[live])
            more = hi - lo >= times
            live = live[more]
            low[live], high[live] = lo[more], hi[more]
            length[live] += 1
        return length, low, high
