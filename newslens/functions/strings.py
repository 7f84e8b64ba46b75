"""String rules and similarities as Columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import fixed_values as fv
from newslens.functions.columns import let


def article_text(headline: Column, description: Column, summary: Column) -> Column:
    """``headline. description. summary``; NULL when any part is NULL."""
    return F.concat(headline, F.lit(". "), description, F.lit(". "), summary)


def has_corp_suffix(name: Column, strict: bool = False) -> Column:
    pattern = fv.CORP_SUFFIX_PATTERN_STRICT if strict else fv.CORP_SUFFIX_PATTERN
    return F.lower(name).rlike(pattern)


def url_path(url: Column) -> Column:
    """Path of a URL. A regex, because ``parse_url`` fails on unescaped characters."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def file_name(url: Column) -> Column:
    return F.regexp_extract(url, r"([^/]*)$", 1)


def url_encode(value: Column) -> Column:
    """Percent-encoding with ``%20`` for a space."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def normalize_exchange(exchange: Column) -> Column:
    """Vendor exchange code; codes without an alias pass through unchanged."""
    alias = F.create_map(
        *[F.lit(x) for code in fv.US_EXCHANGES for x in (code, fv.US_EXCHANGE_CODE)]
    )
    return F.coalesce(F.try_element_at(alias, exchange), exchange)


def partial_levenshtein(a: Column, b: Column) -> Column:
    """Best 0-100 edit similarity of the shorter string with any equally long
    window of the longer one. Runs in the JVM; 0 when a side is empty or NULL."""

    def best(pair: Column) -> Column:
        short, long = pair["short"], pair["long"]
        n = F.length(short)
        return F.array_max(
            F.transform(
                F.sequence(F.lit(1), F.length(long) - n + 1),
                lambda i: F.round(
                    F.lit(100.0)
                    - F.lit(100.0) * F.levenshtein(F.substring(long, i, n), short) / n,
                    6,
                ),
            )
        )

    a_first = F.length(a) <= F.length(b)
    pair = F.struct(
        F.when(a_first, a).otherwise(b).alias("short"),
        F.when(a_first, b).otherwise(a).alias("long"),
    )
    both = (F.length(a) > 0) & (F.length(b) > 0)
    return F.coalesce(F.when(both, let(pair, best)), F.lit(0.0))


def _common_subsequence(masks: dict[str, int], size: int, window: str) -> int:
    """Length of the longest common subsequence, one machine-word step per character."""
    full = (1 << size) - 1
    row = full
    for ch in window:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def partial_ratio_score(a: str | None, b: str | None) -> int:
    """Best-window insert/delete similarity, 0-100, rounded half to even.

    Windows are all substrings of the longer string as long as the shorter one,
    and the shorter windows that overhang either end.
    """
    if not a or not b:
        return 0
    best = 0.0
    for short, long in {(a, b), (b, a)} if len(a) == len(b) else {tuple(sorted((a, b), key=len))}:
        n = len(short)
        masks: dict[str, int] = {}
        for i, ch in enumerate(short):
            masks[ch] = masks.get(ch, 0) | (1 << i)
        windows = {long[max(i, 0) : i + n] for i in range(1 - n, len(long))}
        for window in windows:
            common = _common_subsequence(masks, n, window)
            best = max(best, 200.0 * common / (n + len(window)))
    return round(best)


LANES = 1 << 20


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _window_ratios(short: list[str], long: list[str]) -> np.ndarray:
    """Best window score of each pair, for all windows of all pairs at once.

    A lane is a window of a pair and holds a row of the bit-parallel recurrence for the longest
    common subsequence, in as many 64-bit words as the longest of ``short`` needs.
    """
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (short, long))
    of, within = np.repeat(np.arange(len(m)), m), _counted(m)
    width = m + 2 * n  # characters of the long side, with room for the windows that overhang
    base = np.cumsum(width) - width
    words = int(-(-n.max() // 64))
    masks = np.zeros((words, int(width.sum()) + 1), np.uint64)  # the last column is no character
    characters, shorter, begin = _points(long), _points(short), np.cumsum(n) - n
    at = (base + n)[of] + within
    for k in range(int(n.max())):
        same = np.flatnonzero((k < n[of]) & (shorter[np.minimum(begin[of] + k, len(shorter) - 1)] == characters))
        masks[k // 64, at[same]] |= np.uint64(1 << k % 64)
    count = m + n - 1
    pair, i = np.repeat(np.arange(len(m)), count), _counted(count) + 1  # a window begins at i - n in the long side
    first, size = base[pair] + i, n[pair]
    row = [np.full(len(pair), 2**64 - 1, np.uint64) for _ in range(words)]
    for t in range(int(n.max())):
        place = np.where(t < size, first + t, masks.shape[1] - 1)
        carry = np.uint64(0)
        for w in range(words):
            hit = row[w] & masks[w, place]
            total = row[w] + hit
            over = total < hit
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            row[w] = total | (row[w] ^ hit)
    common = sum((64 - np.bitwise_count(r)).astype(np.int64) for r in row)  # bits past the end stay set
    window = np.minimum(np.minimum(i, size), count[pair] + 1 - i)
    return np.maximum.reduceat(200.0 * common / (size + window), np.cumsum(count) - count)


def _counted(count: np.ndarray) -> np.ndarray:
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def partial_ratios(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """:func:`partial_ratio_score` of many pairs."""
    out = np.zeros(len(a))
    rows, short, long = [], [], []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x and y:
            for s, t in ((x, y), (y, x)) if len(x) == len(y) else (sorted((x, y), key=len),):
                rows.append(k)
                short.append(s)
                long.append(t)
    order = sorted(range(len(rows)), key=lambda j: (len(short[j]), len(long[j])))  # lanes of a chunk are alike
    chunk, size = [], 0
    for j in order:
        chunk.append(j)
        size += len(short[j]) + len(long[j])
        if size >= LANES or j == order[-1]:
            np.maximum.at(out, [rows[c] for c in chunk], _window_ratios([short[c] for c in chunk], [long[c] for c in chunk]))
            chunk, size = [], 0
    return np.rint(out).astype(np.int32)


@F.pandas_udf(T.IntegerType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched partial ratio: all windows of all pairs of a batch together."""
    return pd.Series(partial_ratios(a.tolist(), b.tolist()), dtype="int32")
