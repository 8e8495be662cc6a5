"""FM-index of short sequences over a wavelet matrix, with weighted occurrences, on numpy arrays.

Backward search runs for many patterns at once: each call of `step` extends every pattern by one symbol to the left.
Suffixes are sorted to DEPTH symbols, which is exact for patterns shorter than that.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class WaveletMatrix:
    """Symbols in bit planes of packed words, with counts of ones before each word."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        rest = symbols
        for level in range(self.levels):
            bit = (rest >> (self.levels - 1 - level)) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(rest) - bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.origin = np.zeros(n_symbols, np.int64)
        self.origin = self._descend(np.arange(n_symbols), self.origin)

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.words[level][word] & low)
            bit = (symbols >> (self.levels - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbols, at) - self.origin[symbols]


def suffix_array(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Suffix order by at least `depth` symbols, by doubling the sorted length."""
    n = len(symbols)
    ranks, order, known = symbols.astype(np.int64) + 1, np.arange(n), 1
    while known < depth:
        following = np.zeros(n, np.int64)
        following[: n - known] = ranks[known:]
        keys = ranks * (int(ranks.max()) + 1) + following
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        steps = np.concatenate([[1], (keys[1:] != keys[:-1]).astype(np.int64)])
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(steps)
        known *= 2
        if ranks[order[-1]] == n:
            break
    return order


class FMIndex:
    """Index of pieces, each a run of symbols from 1 on that ends with the separator 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, weights: np.ndarray):
        """`weights` has the weight of the piece that each place belongs to."""
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.tree = WaveletMatrix(symbols[order - 1], n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.weight_before = np.concatenate([[0], np.cumsum(weights[order])])

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns extended to the left by `symbols`."""
        both = self.tree.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        base = self.first[symbols]
        return base + both[: len(low)], base + both[len(low) :]

    def weight(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight_before[high] - self.weight_before[low]


def repeated_windows(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
    """Bit masks of the windows of each piece that have at least two occurrences, by weight, in the index.

    Every piece is searched backwards from some end until the occurrences fall below two: the matching statistic of that
    end. A piece first looks for its leftmost repeated window, and skips to behind the place where a search failed. From
    there searches start at the right end: what they cover is repeated, what contains a failed stretch is not, and the
    next end lies as far to the left as that allows.
    """
    n = len(starts)
    masks = np.zeros(n, np.int64)
    one = np.int64(1)
    active = np.flatnonzero(lengths >= window)
    left, right = np.zeros(n, np.int64), lengths.astype(np.int64).copy()
    from_right = np.zeros(n, bool)
    at = np.full(n, window, np.int64)
    low, high = np.zeros(n, np.int64), np.full(n, index.size, np.int64)

    def restart(lanes, ends):
        at[lanes], low[lanes], high[lanes] = ends, 0, index.size

    while len(active):
        lo, hi = index.step(symbols[starts[active] + at[active] - 1], low[active], high[active])
        fine = index.weight(lo, hi) >= 2
        on = active[fine]
        low[on], high[on] = lo[fine], hi[fine]
        at[on] -= 1
        reached = on[at[on] == left[on]]
        failed = active[~fine]
        done = []
        # From the left: the window is repeated, or the next candidate begins behind the failing word.
        found = reached[~from_right[reached]]
        masks[found] |= one << left[found]
        whole = left[found] + window == right[found]
        done.append(found[whole])
        found = found[~whole]
        from_right[found] = True
        restart(found, right[found])
        missed = failed[~from_right[failed]]
        left[missed] = at[missed]
        over = left[missed] + window > right[missed]
        done.append(missed[over])
        missed = missed[~over]
        restart(missed, left[missed] + window)
        # From the right: all windows down to the left one are repeated, or those behind the failing word.
        closed = reached[from_right[reached] & (at[reached] == left[reached])]
        closed = np.setdiff1d(closed, found, assume_unique=True)
        masks[closed] |= (one << (right[closed] - window + 1)) - (one << left[closed])
        done.append(closed)
        missed = failed[from_right[failed]]
        begin = at[missed]
        some = right[missed] - begin >= window
        masks[missed[some]] |= (one << (right[missed[some]] - window + 1)) - (one << begin[some])
        right[missed] = np.minimum(right[missed] - 1, begin + window - 1)
        over = right[missed] - window <= left[missed]
        done.append(missed[over])
        missed = missed[~over]
        restart(missed, right[missed])
        done = np.concatenate(done)
        if len(done):
            active = np.setdiff1d(active, done, assume_unique=True)
    return masks
