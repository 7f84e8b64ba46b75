"""Simple-8b: numbers in 64-bit words, 4 bits of selector and 60 of data, and blocks that decode alone."""

from __future__ import annotations

import numpy as np


U64 = np.uint64
# Fixed values of the format: numbers in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = (1 << 60) - 1  # with selector 15: the next word is the number itself
BLOCK = 4096
_BITS16 = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """0 for 0, else the number of bits; what needs an escape counts as 60."""
    out = _BITS16[(values & U64(0xFFFF)).astype(np.uint16)]
    for part in (16, 32, 48):
        higher = values >> U64(part)
        if not higher.any():
            break
        some = higher > 0
        out[some] = _BITS16[(higher[some] & U64(0xFFFF)).astype(np.uint16)] + np.uint8(part)
    return np.minimum(out, 60)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """The fullest selector that fits from each place on; places past the end are zeros."""
    return np.concatenate([_fullest(bits[:-1]), _fullest(bits[-1:])])  # only the last row has places past the end


def _fullest(bits: np.ndarray) -> np.ndarray:
    """A selector fits only where the next one of fewer numbers does, so the search ends with the first that fits nowhere."""
    width = bits.shape[1]
    best = np.full(bits.shape, 15, np.uint8)
    widest, span = np.pad(bits, ((0, 0), (0, int(COUNTS[0])))), 1  # the most bits of ``span`` numbers from each place on
    for selector in range(14, -1, -1):
        count = int(COUNTS[selector])
        while span * 2 <= count:
            widest[:, : widest.shape[1] - span] = np.maximum(widest[:, : widest.shape[1] - span], widest[:, span:])
            span *= 2
        fits = np.maximum(widest[:, :width], widest[:, count - span : count - span + width]) <= BITS[selector]
        if not fits.any():
            break
        best[fits] = selector
    return best


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words and, for every block of ``block`` numbers, the index of its first word (blocks + 1)."""
    n = len(values)
    blocks = -(-n // block)
    if not n:
        return np.zeros(0, U64), np.zeros(1, np.int64)
    table = np.zeros((blocks, block), U64)
    table.reshape(-1)[:n] = values
    ends = np.minimum(n - np.arange(blocks) * block, block)
    selectors = _selectors(_bit_lengths(table))
    step = COUNTS[selectors].reshape(-1)
    begins = np.zeros(blocks * block, bool)
    at = np.arange(blocks) * block
    ends += at
    while len(at):  # all blocks advance together, a word at a time
        begins[at] = True
        at = at + step[at]
        alive = at < ends
        at, ends = at[alive], ends[alive]
    first = np.flatnonzero(begins)
    row, chosen = first // block, selectors.reshape(-1)[first]
    flat = np.concatenate([table.reshape(-1), np.zeros(240, U64)])
    limit = (row + 1) * block
    words = chosen.astype(U64) << U64(60)
    for selector in range(2, 16):
        some = np.flatnonzero(chosen == selector)
        for k in range(int(COUNTS[selector]) if len(some) else 0):
            from_ = first[some] + k
            value = np.where(from_ < limit[some], flat[from_], U64(0))
            words[some] |= np.minimum(value, U64(ESCAPE)) << U64(int(BITS[selector]) * k)
    escaped = (chosen == 15) & (flat[first] >= U64(ESCAPE))
    size = 1 + escaped.astype(np.int64)
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), U64)
    out[start] = words
    out[start[escaped] + 1] = flat[first[escaped]]
    offsets = np.concatenate([start[np.searchsorted(row, np.arange(blocks))], [len(out)]])
    return out, offsets.astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """All ``n`` numbers. Blocks need only their own words, so any run of blocks decodes alone."""
    selector = (words >> U64(60)).astype(np.int64)
    data = words & U64(ESCAPE)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero((selector == 15) & (data == U64(ESCAPE))).tolist():
        if not raw[i]:
            raw[i + 1] = True
    count = np.where(raw, 0, COUNTS[selector])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.cumsum(count) - count
    first = row * block + before - before[offsets[:-1]][row] if len(words) else before
    out = np.zeros(n, U64)
    for s in range(2, 16):
        some = np.flatnonzero((selector == s) & ~raw)
        if not len(some):
            continue
        bits, mask = int(BITS[s]), U64((1 << int(BITS[s])) - 1)
        end = np.minimum((row[some] + 1) * block, n)
        for k in range(int(COUNTS[s])):
            to = first[some] + k
            ok = to < end
            out[to[ok]] = (data[some[ok]] >> U64(bits * k)) & mask
    follow = np.flatnonzero(raw)
    out[first[follow - 1]] = words[follow]
    return out


