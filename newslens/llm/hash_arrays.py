"""Tables of 64-bit keys in the shared folder, as files of sorted arrays that tasks map into memory.

A table is cut by the leading bits of its keys, which are hashes and so spread evenly. Every file holds one
array per column; its name says what is in it and its rows don't depend on the attempt that writes it, so a file that
is written twice is the same and takes its name only when it is complete. Files in a folder of the machine's file
system are mapped; of any other store one file at a time is read.
"""

from __future__ import annotations

import json
import mmap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens.llm import files

ROWS = 1 << 18  # about as many rows a file


def bits_for(rows: int) -> int:
    """How many leading bits cut a table of so many rows; one at least, so that signed order is the order of a file."""
    return max(1, (max(1, -(-rows // ROWS)) - 1).bit_length())


def bucket(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("long")


def save(folder: str, name: str, columns: dict[str, np.ndarray]) -> None:
    head, at = {}, 0
    for column, values in columns.items():
        head[column] = (values.dtype.str, len(values), at)
        at += -(-values.nbytes // 64) * 64
    said = json.dumps(head).encode()
    parts = [f"{len(said):016d}".encode(), said, b" " * (-(16 + len(said)) % 64)]
    for values in columns.values():
        parts += [values.tobytes(), b"\0" * (-values.nbytes % 64)]
    written = files.write(folder, "part", parts)
    (fs, path), (_, to) = files.at(written), files.at(f"{folder}/{name}")
    try:
        fs.move(path, to)
    except OSError:  # a store that doesn't replace: another attempt has written the same
        if fs.get_file_info(to).type != pafs.FileType.File:
            raise
        fs.delete_file(path)


@lru_cache(4096)
def _mapped(path: str) -> dict[str, np.ndarray] | None:
    try:
        with open(path, "rb") as source:
            return _columns(np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8))
    except FileNotFoundError:
        return None


def load(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The columns of a file; None without one. Mapped files stay mapped, so a table must be whole before it is read."""
    fs, path = files.at(f"{folder}/{name}")
    if isinstance(fs, pafs.LocalFileSystem):
        return _mapped(path)
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    return _columns(np.frombuffer(files.read(f"{folder}/{name}"), np.uint8))


def _columns(data: np.ndarray) -> dict[str, np.ndarray]:
    size = int(data[:16].tobytes())
    start = -(-(16 + size) // 64) * 64
    out = {}
    for column, (kind, n, at) in json.loads(data[16 : 16 + size].tobytes()).items():
        kind = np.dtype(kind)
        out[column] = data[start + at : start + at + n * kind.itemsize].view(kind)
    return out


def lookup(folder: str, table: str, bits: int, keys: np.ndarray, columns: list[str]) -> list[np.ndarray]:
    """The columns' values at the keys, as doubles; 0 where the table lacks the key."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = [np.zeros(len(keys)) for _ in columns]
    cuts = np.searchsorted(ordered, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.append(cuts, len(ordered))
    for n in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[n : n + 2].tolist()
        part = load(folder, f"{table}-{n}")
        if part is None or not len(part["key"]):
            continue
        at = np.minimum(np.searchsorted(part["key"], ordered[a:b]), len(part["key"]) - 1)
        has = np.flatnonzero(part["key"][at] == ordered[a:b])
        at, to = at[has], order[a + has]
        for values, column in zip(out, columns, strict=True):
            values[to] = part[column][at]
            if f"{column}_place" in part:  # too large for the column's own array
                place = np.searchsorted(part[f"{column}_place"], at)
                place = np.minimum(place, max(0, len(part[f"{column}_place"]) - 1))
                large = np.flatnonzero(part[f"{column}_place"][place] == at) if len(part[f"{column}_place"]) else place[:0]
                values[to[large]] = part[f"{column}_large"][place[large]]
    return out


def narrow(column: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of one byte each, and apart from them the places and values of those that are larger."""
    large = np.flatnonzero(values > 255)
    return {column: np.minimum(values, 255).astype(np.uint8), f"{column}_place": large, f"{column}_large": values[large]}


def by_file(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of each file: ``names`` are columns whose equal values stand together."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy() for c in names]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = tuple(int(v[a]) for v in values)
            if held and own != last:
                yield last, pa.concat_tables(held).combine_chunks()
                held = []
            last = own
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield last, pa.concat_tables(held).combine_chunks()
