"""Ids of words that a task has met, so that each distinct word is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

MAX_KNOWN = 300_000


class WordStore:
    """Numbers words and keeps their ids in one array. Beyond ``max_known`` words all are dropped.

    ``encode`` takes a list of words, and whether they are marked, and returns the ids of all in one
    array and the number of each word's ids.
    """

    def __init__(self, encode: Callable[[list[str], bool], tuple[np.ndarray, np.ndarray]], max_known: int = MAX_KNOWN):
        self.encode, self.max_known = encode, max_known
        self.forget()

    def forget(self) -> None:
        self.number: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self._flat, self._lengths, self._starts = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.known = self.size = 0  # words and ids so far; the buffers are longer

    @property
    def lengths(self) -> np.ndarray:
        return self._lengths[: self.known]

    def _add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        known, size = self.known + len(lengths), self.size + len(flat)
        self._flat = _roomy(self._flat, self.size, size)
        self._lengths, self._starts = (_roomy(b, self.known, known) for b in (self._lengths, self._starts))
        self._flat[self.size : size] = flat
        self._lengths[self.known : known] = lengths
        self._starts[self.known : known] = self.size + np.cumsum(lengths) - lengths
        self.known, self.size = known, size

    def trim(self) -> None:
        """To be called between batches: numbers of an earlier batch are void after it."""
        if self.known > self.max_known:
            self.forget()

    def numbers(self, words: pa.Array, marked: bool) -> np.ndarray:
        """The number of every word; unknown words are encoded."""
        coded = words.dictionary_encode()
        distinct, known = coded.dictionary.to_pylist(), self.number[marked]
        new = [w for w in distinct if w not in known]
        if new:
            known.update(zip(new, range(self.known, self.known + len(new)), strict=True))
            self._add(*self.encode(new, marked))
        own = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        return own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, np.int64)

    def ids(self, numbers: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The first ``count`` ids (all or none) of each word, one after the other."""
        return self._flat[spread(self._starts[numbers], count)]


def _roomy(buffer: np.ndarray, used: int, needed: int) -> np.ndarray:
    """The buffer, or one at least twice as long with the same beginning."""
    if needed <= len(buffer):
        return buffer
    larger = np.empty(max(needed, 2 * len(buffer)), buffer.dtype)
    larger[:used] = buffer[:used]
    return larger


def flattened(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some lists of ids, and the length of each."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for one in lists for i in one), np.int32, int(lengths.sum())), lengths


def spread(starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (count[0] of them), starts[1], ..."""
    total = int(count.sum())
    return np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(total)


def bounds(lists: pa.Array) -> np.ndarray:
    """Offsets of a list array, from 0."""
    offsets = lists.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64)
