"""Finding listed names in texts with a trie of their words, walked over whole Arrow batches.

The names are written once, by Spark, in files of bounded size. A task reads texts as code points and walks the trie
from every word of a slice at once: after the first word only the places go on where some name begins, so the
work is about one lookup per word whatever the number of names. Nothing is exploded, joined or shuffled, and no
catalogue passes through the driver. One larger than a file is searched a file at a time.

A trie is kept as the sorted 64-bit hashes of all beginnings of names, whole words only, with a mark at those that
are names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.settings import shared_dir

U64 = np.uint64
FILE_BYTES = 1 << 25  # of names: what a task holds of the catalogue
SLICE_BYTES = 1 << 20
SPANS = "array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_PRIME = U64(0x9E3779B97F4A7C15)
# Capital letters whose lower case depends on their place or has two characters: such words are lower-cased one by one.
_SPECIAL = (0x0130, 0x03A3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: whether words have it (letters and numbers), and its lower case."""
    in_word, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        ch = chr(i)
        if unicodedata.category(ch)[0] in "LN":
            in_word[i] = True
            low = ch.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return in_word, lower


def _hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, given by their places in lower-case code points."""
    if not len(starts):
        return np.zeros(0, U64)
    length = ends - starts
    total = int(length.sum())
    within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    power = np.full(int(length.max()), _PRIME)
    power[0] = 1
    power = np.multiply.accumulate(power)
    terms = (points[np.repeat(starts, length) + within].astype(U64) + U64(1)) * power[within]
    return _mix(np.add.reduceat(terms, np.cumsum(length) - length) + length.astype(U64))


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of some texts: hash of the lower case, first and last code point (over all texts), and the bounds of texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    bounds = before[offsets - offsets[0]]
    in_word, lower = _letters()
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = in_word[points]
    cut = np.zeros(len(points) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    hashes = _hashes(lower[points], starts, ends)
    special = np.flatnonzero(np.isin(points, _SPECIAL))
    for k in np.unique(np.searchsorted(starts, special, "right") - 1).tolist() if len(special) else []:
        word = points[starts[k] : ends[k]].tobytes().decode("utf-32-le").lower()
        word = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        hashes[k] = _hashes(word, np.array([0]), np.array([len(word)]))[0]
    return hashes, starts, ends, bounds


class Trie:
    """Names as lower-case words joined by single blanks."""

    def __init__(self, names: pa.Array):
        hashes, starts, _, bounds = text_words(names)
        first = np.searchsorted(starts, bounds)
        at, end = first[:-1], first[1:]
        state, keys, ends = np.zeros(len(at), U64), [], []
        while len(at):
            state = _mix(state * _PRIME + hashes[at])
            keys.append(state)
            at = at + 1
            ends.append(at == end)
            more = at < end
            at, end, state = at[more], end[more], state[more]
        keys = np.concatenate([np.zeros(0, U64), *keys])
        ends = np.concatenate([np.zeros(0, bool), *ends])
        self.keys, of = np.unique(keys, return_inverse=True)
        self.is_name = np.zeros(len(self.keys), bool)
        self.is_name[of[ends]] = True

    def hits(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of every name found. ``rows``: index of the first word of each text, and of none."""
        if not len(self.keys) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        last = np.repeat(rows[1:], np.diff(rows))  # where the text of each word ends
        place, state, depth = np.arange(len(hashes)), np.zeros(len(hashes), U64), 0
        starts, ends = [], []
        while len(place):
            state = _mix(state * _PRIME + hashes[place + depth])
            at = np.minimum(np.searchsorted(self.keys, state), len(self.keys) - 1)
            known = self.keys[at] == state
            place, state, at = place[known], state[known], at[known]
            named = self.is_name[at]
            starts.append(place[named])
            ends.append(place[named] + depth)
            depth += 1
            more = place + depth < last[place]
            place, state = place[more], state[more]
        return np.concatenate(starts), np.concatenate(ends)


@lru_cache(1)
def _trie(path: str) -> Trie:
    fs, at = (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)
    return Trie(pq.read_table(at, filesystem=fs, columns=["gram"]).column("gram").combine_chunks())


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The texts in order, about ``most`` bytes at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield texts.slice(first, end - first)
        first, done = end, int(sizes[end - 1])


def spans(texts: pa.Array, tries: list[Callable[[], Trie]]) -> pa.Array:
    """``(start, end)`` of the names in each text, in order: 0-based code points, both inclusive. A name inside of a
    longer hit is left out; hits that only overlap stay. Empty for a NULL text."""
    out = []
    for part in slices(texts):
        hashes, starts, ends, bounds = text_words(part)
        rows = np.searchsorted(starts, bounds)
        found = [trie().hits(hashes, rows) for trie in tries]
        first, last = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        begin, end = starts[first], ends[last] - 1
        order = np.lexsort((-end, begin))
        begin, end = begin[order], end[order]
        furthest = np.maximum.accumulate(np.concatenate([[-1], end[:-1]])) if len(end) else end
        begin, end = begin[end > furthest], end[end > furthest]
        offsets = np.searchsorted(begin, bounds)
        row = np.searchsorted(bounds, begin, "right") - 1
        values = [pa.array((v - bounds[row]).astype(np.int32)) for v in (begin, end)]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(values, ["start", "end"]))
        out.append(lists.cast(_SPANS))
    return pa.concat_arrays(out) if out else pa.array([], _SPANS)


def name_files(grams: DataFrame, file_bytes: int = FILE_BYTES) -> list[str]:
    """Write ``grams(gram)`` in files of about ``file_bytes`` at most; their paths, a few strings."""
    spark = grams.sparkSession
    size = grams.agg(F.sum(F.octet_length("gram") + 8)).first()[0] or 0
    path = shared_dir(spark, "names")
    grams.select("gram").repartition(-(-size // file_bytes) or 1, "gram").write.parquet(path)
    return sorted(spark.read.schema("gram string").parquet(path).inputFiles())


def name_spans(paths: list[str]) -> Callable[[Column], Column]:
    """The places of the names of these files in a text column, as an Arrow function."""

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        return spans(texts, [lambda path=path: _trie(path) for path in paths])

    return find
