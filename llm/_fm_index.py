"""An FM-index over sequences of integers: a wavelet matrix of the Burrows-Wheeler transform, searched backwards for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols below 2^levels in packed bits, a plane per level, with counts per 64-bit word."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.planes = []
        for level in reversed(range(levels)):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(np.uint64)
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(packed))[:-1])).astype(np.int32)
            self.planes.append((level, packed, ones, len(bit) - int(bit.sum())))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the prefix of length `at` ends among the symbol's own run; less descend(symbol, 0) it is the symbol's count there."""
        for level, packed, ones, zeros in self.planes:
            word, mask = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[word] + np.bitwise_count(packed[word] & mask)
            at = np.where(symbol >> level & 1, zeros + rank, at - rank)
        return at


def suffix_order(symbols: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; borders come before all symbols, the earlier ones first."""
    n, borders = len(symbols), int(border.sum())
    rank = np.where(border, np.cumsum(border) - 1, symbols + borders).astype(np.int64)
    step = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[: max(n - step, 0)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        if new.max(initial=0) == n - 1:
            return order
        rank, step = new, step * 2


class FMIndex:
    """Sequences of symbols from 1, one after the other with a border after each. Matches are told up to `width` symbols."""

    def __init__(self, sequences: list[np.ndarray], width: int):
        self.width = width
        lengths = np.array([len(s) for s in sequences])
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        border = np.zeros(len(text), bool)
        border[self.starts + lengths] = True
        text[~border] = np.concatenate(sequences)
        self.n, self.most = len(text), int(text.max(initial=0))
        order = suffix_order(text, border)
        self.wavelet = WaveletMatrix(text[order - 1], max(1, self.most.bit_length()))
        symbols = np.arange(self.most + 1)
        before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.most + 1))[:-1]))
        self.base = before - self.wavelet.descend(symbols, np.zeros(len(symbols), np.int64))
        self.shared = self._shared_prefixes(text, border, order)
        self._edges: dict[int, np.ndarray] = {}
        #: The first place in the text of each group of suffixes that share `width` symbols.
        self.first = np.minimum.reduceat(order, self.edges(width)[:-1])

    def _shared_prefixes(self, text: np.ndarray, border: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Symbols that each suffix shares with the one before in order, `width` at most."""
        shared, going = np.zeros(self.n, np.uint8), np.arange(1, self.n)
        for k in range(self.width):
            a, b = order[going - 1] + k, order[going] + k
            inside = (a < self.n) & (b < self.n)
            going, a, b = going[inside], a[inside], b[inside]
            going = going[(text[a] == text[b]) & ~border[a]]
            shared[going] = k + 1
        return shared

    def edges(self, length: int) -> np.ndarray:
        """Bounds of the groups of suffixes that share `length` symbols."""
        if length not in self._edges:
            self._edges[length] = np.append(np.flatnonzero(self.shared < length) if length else [0], self.n)
        return self._edges[length]

    def _widened(self, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        edges = self.edges(length)
        at = np.searchsorted(edges, low, "right")
        return edges[at - 1], edges[at]

    def matching_statistics(self, patterns: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each place of each pattern: the length of the longest match that begins there (`width` at most), and where such a match of full width first is in the text (else -1).

        All patterns are read from their ends together. A match that can't be
        extended is cut at its right end, symbol by symbol, until it can.
        """
        flat = np.concatenate(patterns) if patterns else np.zeros(0, np.int64)
        ends = np.cumsum([len(p) for p in patterns]).astype(np.int64)
        sizes = np.diff(ends, prepend=0)
        low, high, length = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n), np.zeros(len(patterns), np.int64)
        lengths, places = np.zeros(len(flat), np.int64), np.full(len(flat), -1)
        for step in range(int(sizes.max(initial=0))):
            going = np.flatnonzero(sizes > step)
            at = ends[going] - 1 - step
            open_ = going[(flat[at] > 0) & (flat[at] <= self.most)]
            lost = np.setdiff1d(going, open_, assume_unique=True)
            while len(open_):
                symbol = flat[ends[open_] - 1 - step]
                a, b = self.base[symbol] + self.wavelet.descend(symbol, low[open_]), self.base[symbol] + self.wavelet.descend(symbol, high[open_])
                found = a < b
                low[open_[found]], high[open_[found]] = a[found], b[found]
                length[open_[found]] += 1
                open_ = open_[~found]
                lost = np.concatenate((lost, open_[length[open_] == 0]))
                open_ = open_[length[open_] > 0]
                length[open_] -= 1
                for k in np.unique(length[open_]):
                    these = open_[length[open_] == k]
                    low[these], high[these] = self._widened(low[these], int(k))
            low[lost], high[lost], length[lost] = 0, self.n, 0
            over = going[length[going] >= self.width]
            low[over], high[over] = self._widened(low[over], self.width)
            length[over] = self.width
            lengths[at] = length[going]
            places[ends[over] - 1 - step] = self.first[np.searchsorted(self.edges(self.width), low[over])]
        cuts = ends[:-1]
        return list(zip(np.split(lengths, cuts), np.split(places, cuts)))
