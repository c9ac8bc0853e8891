"""An FM-index over runs of integer symbols: suffix order, wavelet ranks, sampled positions."""

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling.

    Only suffixes whose rank is still shared are sorted again, so a round costs what is left.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64).reshape(-1)
    order = np.argsort(rank, kind="stable")
    first = np.concatenate([[True], np.diff(rank[order]) > 0])
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    width = 1
    while True:
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        open_rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(open_rows) or width >= 2 * n:
            return order
        suffixes = order[open_rows]
        after = suffixes + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        again = np.lexsort((second, rank[suffixes]))
        suffixes, second = suffixes[again], second[again]
        order[open_rows] = suffixes
        group = rank[suffixes]
        new = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(second) != 0)])
        first[open_rows] = new
        rank[suffixes] = open_rows[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        width *= 2


class WaveletRanks:
    """How often a symbol occurs before a row, for arrays of symbols and rows."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels = []
        for level in range(self.bits - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)])
            self.levels.append((level, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        start = np.zeros_like(row)
        for level, ones, zeros in self.levels:
            bit = ((symbol >> level) & 1).astype(bool)
            one_row, one_start = ones[row], ones[start]
            row = np.where(bit, zeros + one_row, row - one_row)
            start = np.where(bit, zeros + one_start, start - one_start)
        return row - start

    def access(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols in the given rows, and how often each occurs before its row."""
        symbol, start = np.zeros_like(row), np.zeros_like(row)
        for level, ones, zeros in self.levels:
            bit = ones[row + 1] > ones[row]
            one_row, one_start = ones[row], ones[start]
            symbol |= bit.astype(symbol.dtype) << level
            row = np.where(bit, zeros + one_row, row - one_row)
            start = np.where(bit, zeros + one_start, start - one_start)
        return symbol, row - start


class FMIndex:
    """Runs of symbols 1 .. size-1. A phrase is found within one run only.

    Runs are joined by separators, each a symbol of its own below all others, so suffixes are
    never compared past the end of a run.
    """

    def __init__(self, runs: list[np.ndarray], size: int):
        lengths = np.array([len(r) for r in runs], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths  # one separator before each run
        n = int(lengths.sum()) + len(runs)
        text = np.zeros(n, np.int64)
        body = np.ones(n, bool)
        body[self.starts - 1] = False
        text[body] = np.concatenate(runs)
        unique = text + len(runs)
        unique[~body] = np.arange(len(runs))
        order = suffix_order(unique)
        counts = np.bincount(text, minlength=size)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.rows = n
        self.ranks = WaveletRanks(text[order - 1], size)
        kept = (order % SAMPLE == 0) | np.isin(order, self.starts)
        self.sampled = kept
        self.slot = np.cumsum(kept) - 1
        self.samples = order[kept]

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length (one per row), by backward search."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.rows, np.int64)
        alive = np.arange(len(phrases))
        for symbol in phrases.T[::-1]:
            symbol = symbol[alive]
            low[alive] = self.before[symbol] + self.ranks.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.ranks.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: steps back to a sampled row, counted."""
        rows = rows.copy()
        out, steps = np.zeros_like(rows), np.zeros_like(rows)
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.sampled[rows[open_]]
            done = open_[hit]
            out[done] = self.samples[self.slot[rows[done]]] + steps[done]
            open_ = open_[~hit]
            symbol, rank = self.ranks.access(rows[open_])
            rows[open_] = self.before[symbol] + rank
            steps[open_] += 1
        return out

    def run_of(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run number and place within the run."""
        run = np.searchsorted(self.starts, positions, side="right") - 1
        return run, positions - self.starts[run]
