"""Repeated stretches of words: every maximal run of every text, and the text without the repetitions.

A run is a stretch of at least ``least`` words in which words ``period`` apart are equal, at least two periods
long, that no neighbouring word extends; its period is the smallest one. Texts stay where they are: nothing is
shuffled, a task works on slices of about a megabyte, and a text is never cut.

Runs are found by longest common extensions (LCE) between the points of a harmonic grid: for each period ``p``
the places 0, p, 2p, ... of the slice. A run of two periods holds two neighbouring points with equal words, and the
extensions from there, forwards and backwards, give its ends. An extension compares words until both places stand on
samples of a difference cover (at most 30 steps), and from there takes the minimum of a sparse table over the common
prefixes of the sorted samples. Only the samples, 6 of 31 places, are sorted.

Defined results: a null or empty text has no words, no runs and the empty text; white space is ASCII; a word stands
for its exact bytes; repeated rows are texts of their own; no rows give no rows; other columns are carried or ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions.columns import let
from newslens.llm import frames, textcore
from newslens.llm.wordstore import spread

LEAST = 12
SLICE_BYTES = 1 << 20
CHUNK = 1 << 20  # grid pairs whose extensions are asked at a time
# A perfect difference cover. Every number below 31 is a difference of two of them modulo 31.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)


def _steps_to_samples() -> np.ndarray:
    """By two places modulo 31: how far both move until both stand on samples."""
    sampled = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    steps = np.arange(MODULUS)
    both = sampled[steps[:, None, None] + steps] & sampled[steps[None, :, None] + steps]
    return both.argmax(2)


_STEPS = _steps_to_samples()
_ROW = np.full(MODULUS, -1)
_ROW[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """Longest common extensions of a word sequence. Negative numbers must stand once each."""

    def __init__(self, words: np.ndarray):
        self.width = -(-(len(words) + MODULUS) // MODULUS) + 1  # samples of each residue
        padded = -np.arange((self.width + 1) * MODULUS, dtype=np.int32) - np.int32(max(0, -int(words.min(initial=0))) + 1)
        padded[: len(words)] = words
        self.words = padded
        self._sort()

    def _sort(self) -> None:
        v, width = MODULUS, self.width
        blocks = np.concatenate([self.words[d : d + width * v].reshape(width, v) for d in COVER])
        names = np.unique(np.ascontiguousarray(blocks).view(f"V{4 * v}").ravel(), return_inverse=True)[1]
        names = names.reshape(len(COVER), width).astype(np.int64)
        total, step, levels = names.size, 1, [names.ravel()]
        while names.max() + 1 < total and step < width:  # names of twice as many blocks
            after = np.full_like(names, -1)
            after[:, :-step] = names[:, step:]
            names = np.unique(names * (total + 1) + after + 1, return_inverse=True)[1].reshape(names.shape)
            levels.append(names.ravel())
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(total, np.int64)
        self.rank[order] = np.arange(total)
        self.table = [self._prefixes(order[:-1], order[1:], levels)]
        step = 1
        while 2 * step <= total - 1:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _prefixes(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of neighbouring samples: whole blocks by the names, then single words."""
        width = self.width
        room = width - np.maximum(a % width, b % width)
        blocks = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(blocks < room)
            same = levels[k][a[inside] + blocks[inside]] == levels[k][b[inside] + blocks[inside]]
            blocks[inside[same]] += 1 << k
        place = np.array(COVER)
        x = place[a // width] + (a % width + blocks) * MODULUS
        y = place[b // width] + (b % width + blocks) * MODULUS
        length = blocks * MODULUS
        alive = np.arange(len(a))
        for k in range(MODULUS):
            far = np.maximum(x[alive], y[alive]) + k < len(self.words)
            alive = alive[far]
            alive = alive[self.words[x[alive] + k] == self.words[y[alive] + k]]
            length[alive] += 1
        return length

    def _of_samples(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x, y = (self.rank[_ROW[p % MODULUS] * self.width + p // MODULUS] for p in (x, y))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            out[some] = np.minimum(self.table[k][low[some]], self.table[k][high[some] - (1 << k)])
        return out

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from ``x`` and from ``y`` on are equal; ``x`` and ``y`` differ everywhere."""
        steps = _STEPS[x % MODULUS, y % MODULUS]
        out = np.zeros(len(x), np.int64)
        alive = np.arange(len(x))
        for k in range(MODULUS):
            ready = steps[alive] == k
            some = alive[ready]
            if len(some):
                out[some] = k + self._of_samples(x[some] + k, y[some] + k)
            alive = alive[~ready]
            same = self.words[x[alive] + k] == self.words[y[alive] + k]
            out[alive[~same]] = k
            alive = alive[same]
            if not len(alive):
                break
        return out


def runs(words: np.ndarray, longest: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs by start, then period. ``longest``: words of the longest text in ``words``."""
    n = len(words)
    found = [np.zeros((0, 3), np.int64)]
    if longest >= 2:
        forward, backward = Extensions(words), Extensions(words[::-1])

    def resolve(x: np.ndarray, p: np.ndarray) -> None:
        after = forward(x, x + p)
        before = backward(n - x, n - x - p)
        good = (before < p) & (after + before >= p) & (after + before + p >= least)  # the first point of its run
        found.append(np.stack([(x - before)[good], (x + p + after)[good], p[good]], 1))

    places, periods, size = [], [], 0
    for p in range(1, longest // 2 + 1):
        grid = words[::p]
        same = np.flatnonzero(grid[1:] == grid[:-1])
        if len(same):
            places.append(same * p)
            periods.append(np.full(len(same), p))
            size += len(same)
        if size >= CHUNK:
            resolve(np.concatenate(places), np.concatenate(periods))
            places, periods, size = [], [], 0
    if size:
        resolve(np.concatenate(places), np.concatenate(periods))
    start, end, period = np.concatenate(found).T
    order = np.lexsort((period, end, start))  # a stretch also shows multiples of its period
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _slice(texts: list[bytes], least: int) -> tuple[list[int], list[list[dict]], list[bytes]]:
    """Words, runs and collapsed text of every text."""
    number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    split = [text.split() for text in texts]  # bytes are split at ASCII white space
    counts = np.array([len(s) for s in split])
    begins = np.concatenate([[0], np.cumsum(counts + 1)])
    stream = np.empty(begins[-1], np.int32)
    stream[begins[1:] - 1] = -np.arange(1, len(split) + 1)  # an end of its own for each text
    inside = np.ones(len(stream), bool)
    inside[begins[1:] - 1] = False
    stream[inside] = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(split)), np.int32, int(counts.sum()))
    start, end, period = runs(stream, int(counts.max(initial=0)), least)
    owner = np.searchsorted(begins, start, "right") - 1
    dropped = np.zeros(len(stream), bool)
    lengths = end - start - period
    dropped[spread(start + period, lengths)] = True
    of: list[list[dict]] = [[] for _ in texts]
    for k, s, e, p in zip(owner.tolist(), (start - begins[owner]).tolist(), (end - begins[owner]).tolist(), period.tolist(), strict=True):
        of[k].append({"start": s, "length": e - s, "period": p})
    collapsed = []
    for k, ws in enumerate(split):
        if of[k]:
            gone = dropped[begins[k] : begins[k + 1] - 1].tolist()
            ws = [w for w, drop in zip(ws, gone, strict=True) if not drop]
        collapsed.append(b" ".join(ws))
    return counts.tolist(), of, collapsed


RUN = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, least: int = LEAST) -> DataFrame:
    """The kept columns with ``n_words``, ``runs`` (by start, then period; places are word numbers from 0) and
    ``collapsed``: the words that no run contains after its first period, joined by single spaces."""
    keep = docs.columns if keep is None else keep
    rows = frames.pack(docs, text, keep)
    added = T.StructType.fromDDL(f"n_words long, runs {RUN}, collapsed string")
    schema = T.StructType([rows.schema["row"], rows.schema["text"], *added.fields])
    carried = text in keep

    def work(batches):
        for batch in batches:
            for first, end, data, offsets in textcore.slices(batch.column("text"), SLICE_BYTES):
                raw, at = data.tobytes(), offsets.tolist()
                n, of, collapsed = _slice([raw[a:b] for a, b in itertools.pairwise(at)], least)
                part = batch.slice(first, end - first)
                own = part.column("text") if carried else pa.nulls(part.num_rows, part.schema.field("text").type)
                columns = [part.column("row"), own, pa.array(n, pa.int64()), pa.array(of, _RUN), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = rows.mapInArrow(work, schema)
    return frames.unpack(found, text, keep, n_words=F.col("n_words"), runs=F.col("runs"), collapsed=F.col("collapsed"))


def with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, a tenth of the texts made periodic from a place on, by the contract's rule."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        place = F.struct(a.alias("a"), (F.floor((n - a) / (g % 8 + 3)) + 1).alias("p"))
        at = lambda i, ap: F.when(i < ap["a"], i).otherwise(ap["a"] + (i - ap["a"]) % ap["p"]).cast("int")
        return let(place, lambda ap: F.array_join(F.transform(words, lambda _, i: F.get(words, at(i, ap))), " "))

    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    planted = let(words, lambda ws: F.when(F.size(ws) > 0, periodic(ws)).otherwise(F.lit("")))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op11(spark, sf_dir: str) -> DataFrame:
    docs = with_planted_run(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = find_runs(docs, keep=["doc_id"])
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
