"""Merges of symbol pairs for many words at once, on flat numpy arrays.

In a round, every word finds the best rank among its pairs (a minimum per segment) and merges all places of that rank at
once, from the left, as far as the pairs that the merges make are worse. Merged symbols leave the arrays, and so do words
without a pair. The result is that of merging one pair after the other, the best first and of equals the leftmost.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int32).max


class Rounds:
    """Pairs of symbols ``lefts, rights``, the symbol that each makes and its rank; lower ranks come first."""

    def __init__(self, lefts, rights, made, ranks):
        lefts, rights, made, ranks = (np.asarray(x, np.int64) for x in (lefts, rights, made, ranks))
        self.width = int(max(lefts.max(initial=0), rights.max(initial=0), made.max(initial=0))) + 1
        self.result = np.append(made, -1).astype(np.int32)  # by pair; the last entry is no pair
        self.rank = np.append(ranks, NONE).astype(np.int32)
        # pairs whose result may at once be part of a pair as good or better
        best = np.full(self.width, NONE, np.int64)
        np.minimum.at(best, lefts, ranks)
        np.minimum.at(best, rights, ranks)
        self.eager = np.append(best[made] <= ranks, False)
        self._place(lefts * self.width + rights)

    def _place(self, keys: np.ndarray) -> None:
        """A hash table from the key of a pair to its number."""
        self.bits = max(12, int(len(keys) * 16).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.pair = np.full(1 << self.bits, -1, np.int32)
        number = np.arange(len(keys))
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several on one slot the last stays
            placed = self.keys[at] == keys
            self.pair[at[placed]] = number[placed]
            keys, number, at = keys[~placed], number[~placed], (at[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 for those that make nothing."""
        keys = left.astype(np.int64) * self.width + right
        at = self._slot(keys)
        seen = self.keys[at]
        found = np.where(seen == keys, self.pair[at], np.int32(-1))
        open_ = np.flatnonzero((seen >= 0) & (seen != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.pair[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return found

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """For symbols end to end, with the number of their word: at each place the symbol that begins there in the end,
        or -1 where a symbol was merged into the one before. Symbols outside all pairs stay as they are."""
        symbols = symbols.copy()
        final = np.full(len(symbols), -1, symbols.dtype)
        place = np.arange(len(symbols))
        while len(symbols):
            pair = np.full(len(symbols), -1, np.int32)
            inside = np.flatnonzero(word[1:] == word[:-1])
            pair[inside] = self.pairs(symbols[inside], symbols[inside + 1])
            rank = self.rank[pair]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(symbols)))
            live = best < NONE
            if not live.all():
                final[place[~live]] = symbols[~live]
                symbols, word, place, pair, rank, best = (x[live] for x in (symbols, word, place, pair, rank, best))
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == best)
            fresh = np.concatenate([[True], np.diff(at) != 1])  # in a run of overlapping pairs every second one
            at = at[(at - at[fresh][np.cumsum(fresh) - 1]) & 1 == 0]
            eager = self.eager[pair[at]]
            if eager.any():
                at = at[~self._late(symbols, word, pair, at, eager)]
            symbols[at] = self.result[pair[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, place = symbols[keep], word[keep], place[keep]
        return final

    def _late(self, symbols: np.ndarray, word: np.ndarray, pair: np.ndarray, at: np.ndarray,
              eager: np.ndarray) -> np.ndarray:
        """Which places stand, in their word, behind one whose merge makes a pair that is as good or better."""
        e = np.flatnonzero(eager)
        own, mine, limit = at[e], self.result[pair[at[e]]], self.rank[pair[at[e]]]
        after = np.minimum(own + 2, len(symbols) - 1)
        right = self.rank[self.pairs(mine, symbols[after])]
        better = (right <= limit) & (own + 2 < len(symbols)) & (word[after] == word[own])
        before = np.maximum(own - 1, 0)
        last = at[np.maximum(e - 1, 0)]
        touching = (e > 0) & (last + 2 == own)  # the neighbour on the left has just been merged itself
        left = self.rank[self.pairs(np.where(touching, self.result[pair[last]], symbols[before]), mine)]
        better |= (left <= limit) & (own > 0) & (word[before] == word[own])
        trigger = np.zeros(len(at), np.int64)
        trigger[e[better]] = 1
        earlier = np.cumsum(trigger) - trigger
        starts = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
        return earlier > earlier[starts][np.cumsum(starts) - 1]
