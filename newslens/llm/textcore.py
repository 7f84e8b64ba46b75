"""Words of Arrow text columns as numpy arrays, without a Python loop over rows.

A word is a longest run of bytes 0-9, a-z, A-Z or >= 0x80 of the UTF-8 text, that is
of the characters ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` once A-Z is lower-cased. A null
text has no words. Words never reach over the end of a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_PRIME = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _lower_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return table


WORD_BYTE = _lower_table()


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, n of each at least."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_PRIME, pow(_PRIME, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(column, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``max_bytes``; one row is never cut."""
    if not len(column):
        return
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, starts and ends of words, and per row the index of its first word (rows + 1)."""
    low = WORD_BYTE[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True  # a row begins, or the text ends, here
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same wherever the same bytes stand."""
    power, inverse = _pow(len(low) + 1)
    total = np.zeros(len(low) + 1, U64)
    np.cumsum((low.astype(U64) + U64(1)) * power[: len(low)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and per row the index of its first word (rows + 1)."""
    low, starts, ends, rows = word_spans(data, offsets)
    return span_hashes(low, starts, ends), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` consecutive words of a row, and per row the index of its first one.

    A row of fewer words, but not none, has one shingle of all its words.
    """
    n_words = np.diff(rows)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(bounds[-1]) + np.repeat(rows[:-1] - bounds[:-1], count)
    end = np.repeat(rows[1:], count)
    power, _ = _pow(size + 1)
    out = np.zeros(len(at), U64)
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    for k in range(size):
        out += np.where(at + k < end, padded[at + k] | U64(1), U64(0)) * power[k + 1]
    return mix(out), bounds
