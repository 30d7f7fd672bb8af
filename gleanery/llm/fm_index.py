"""FM-index over a sequence of small integers, in numpy.

The sequence consists of runs of symbols from 1 on, each closed by a 0. All queries are
answered for many patterns at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Sort the suffixes by prefix doubling; only suffixes that still tie are sorted again.

    Zeros are ordered by their places, so no two suffixes tie beyond the end of a run.
    """
    n = len(seq)
    zeros = int((seq == 0).sum())
    first = seq.astype(np.int64) + zeros
    first[seq == 0] = np.arange(zeros)
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)

    def settle(places: np.ndarray, differs: np.ndarray) -> np.ndarray:
        """Rank the suffixes at ``places`` by the start of their group; the places of those that tie."""
        starts = np.flatnonzero(differs)
        sizes = np.diff(np.append(starts, len(places)))
        rank[order[places]] = np.repeat(places[starts], sizes)
        return places[np.repeat(sizes > 1, sizes)]

    ordered = first[order]
    tied = settle(np.arange(n), np.append(True, ordered[1:] != ordered[:-1])) if n else np.zeros(0, np.int64)
    step = 1
    while len(tied):
        suffixes = order[tied]
        key = rank[suffixes] * n + rank[suffixes + step]
        by = np.argsort(key, kind="stable")
        order[tied] = suffixes[by]
        key = key[by]
        tied = settle(tied, np.append(True, key[1:] != key[:-1]))
        step *= 2
    return order


class _Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.cells = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.cells), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        cell, shift = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << shift) - np.uint64(1)
        return self.before[cell] + np.bitwise_count(self.cells[cell] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.cells[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class _Wavelet:
    """A wavelet tree, stored level by level: at each level the zeros of a bit stand before its ones."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = []
        for shift in reversed(range(max(1, int(symbols - 1).bit_length()))):
            one = (seq >> shift & 1).astype(bool)
            self.levels.append((shift, _Bits(one), len(seq) - int(one.sum())))
            seq = np.concatenate([seq[~one], seq[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low = np.zeros_like(at)
        for shift, bits, zeros in self.levels:
            one = symbol >> shift & 1 == 1
            up_low, up_at = bits.rank(low), bits.rank(at)
            low, at = np.where(one, zeros + up_low, low - up_low), np.where(one, zeros + up_at, at - up_at)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for shift, bits, zeros in self.levels:
            one = bits.get(at)
            up_low, up_at = bits.rank(low), bits.rank(at)
            low, at = np.where(one, zeros + up_low, low - up_low), np.where(one, zeros + up_at, at - up_at)
            symbol |= one.astype(symbol.dtype) << shift
        return symbol, at - low


class FMIndex:
    """Counts and locates patterns in ``seq``; every ``sample``-th place and every start of a run is kept."""

    def __init__(self, seq: np.ndarray, symbols: int, sample: int = 8):
        seq = seq.astype(np.int64)
        order = suffix_array(seq)
        bwt = seq[order - 1]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols))))
        self.wavelet = _Wavelet(bwt, symbols)
        # a place behind a 0 starts a run: walking left never has to pass a 0
        kept = (order % sample == 0) | (bwt == 0)
        self.kept, self.places = _Bits(kept), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each pattern: row i of ``patterns`` up to ``lengths[i]``.

        Searched backwards, all patterns in step; those that cannot occur drop out.
        """
        low = np.zeros(len(lengths), np.int64)
        high = np.full(len(lengths), self.starts[-1])
        for step in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= step) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - step]
            ranks = self.wavelet.rank(np.tile(symbol, 2), np.concatenate([low[live], high[live]]))
            low[live] = self.starts[symbol] + ranks[: len(live)]
            high[live] = self.starts[symbol] + ranks[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffixes given by their rows, by walking left to a kept place."""
        rows, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.kept.get(rows))
        while len(live):
            symbol, before = self.wavelet.symbol_and_rank(rows[live])
            rows[live] = self.starts[symbol] + before
            steps[live] += 1
            live = live[~self.kept.get(rows[live])]
        return self.places[self.kept.rank(rows)] + steps
