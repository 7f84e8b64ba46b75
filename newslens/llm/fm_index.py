"""A full-text index over word numbers: Burrows-Wheeler transform, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of every suffix in order, by prefix doubling. Only ranks that still tie are sorted again.

    ``text`` holds positive numbers; a suffix that ends comes before one that goes on.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.zeros(n + 1, np.int64)  # the empty suffix has rank 0
    ordered = text[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else np.zeros(0, bool)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(1, n + 1), 0))
    width = 1
    while n:
        tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(tied):
            break
        at = order[tied]
        follow = rank[np.minimum(at + width, n)]
        by = np.lexsort((follow, rank[at]))
        at, follow, group = at[by], follow[by], rank[at[by]]
        order[tied] = at
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        head[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied + 1, 0))
        width *= 2
    return order


class FMIndex:
    """Counts and locates phrases in ``text``, an array of numbers from 1 to ``sigma``."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 16):
        full = np.concatenate([text.astype(np.int64), [0]])  # one end mark, smaller than all
        order = suffix_array(full + 1)
        last = full[order - 1]
        self.n, self.sample, self.sigma = len(full), sample, sigma
        self.below = np.concatenate([[0], np.cumsum(np.bincount(full, minlength=sigma + 1))])
        self.levels: list[tuple[int, np.ndarray, int]] = []  # bit, ones before each row, zeros
        row = last
        for bit in reversed(range(max(1, int(sigma).bit_length()))):
            ones = (row >> bit) & 1
            before = np.concatenate([[0], np.cumsum(ones)])
            self.levels.append((bit, before, self.n - int(before[-1])))
            row = np.concatenate([row[ones == 0], row[ones == 1]])
        self.last = last
        kept = order % sample == 0
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.kept, self.kept_at = kept, order[kept]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        low, high = np.zeros_like(row), row
        for bit, before, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            lo, hi = before[low], before[high]
            low = np.where(one, zeros + lo, low - lo)
            high = np.where(one, zeros + hi, high - hi)
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [from, to) of all phrases (one a line, equally long), by backward search."""
        count = len(phrases)
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        alive = np.arange(count)
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, k]
            start = self.below[symbol]
            lo = start + self.rank(symbol, low[alive])
            hi = start + self.rank(symbol, high[alive])
            low[alive], high[alive] = lo, hi
            alive = alive[lo < hi]
            if not len(alive):
                break
        return low, np.where(high > low, high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back until a row whose position is kept."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            row = at[todo]
            done = self.kept[row]
            found = todo[done]
            out[found] = self.kept_at[self.kept_before[row[done]]] + steps[found]
            todo, row = todo[~done], row[~done]
            symbol = self.last[row]
            at[todo] = self.below[symbol] + self.rank(symbol, row)
            steps[todo] += 1
        return out
