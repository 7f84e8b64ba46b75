"""Benchmark decontamination: an FM-index per shard of documents, searched for all benchmark windows.

A task cuts its documents into shards of about ``shard_words`` words. Word numbers come
from the benchmark's own vocabulary; a run of document words that all belong to it is
indexed if it is long enough to hold a window, and no other text can hold one. Windows
are searched backward through the index, their places found by sampled suffix positions,
and overlapping places merged into removal spans.

Spark deals the benchmark to groups of about ``group_words`` words and writes each one's
phrases to a file of the shared folder; only the files' names reach the driver. A task scans
its documents in one pass and holds one group at a time, so memory does not grow with the
benchmark; a single item is never parted.

Defined results: null or wordless texts have no words and are never hit; items without
words, or null, have no window; repeated items with one id count once; a null id counts as
the empty string; empty tables give empty results or no hits; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import files, frames, textcore
from newslens.llm.fm_index import FMIndex
from newslens.settings import shared_dir, stored

WINDOW = 13
SHARD_WORDS = 1 << 20
GROUP_WORDS = 2_000_000
ADDED = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


class Phrases:
    """The windows of a group of benchmark items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        column = pa.array([text for _, text in items], pa.large_string())
        parts = [textcore.words(d, o) for _, _, d, o in textcore.slices(column)]
        hashes = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, textcore.U64)
        counts = np.concatenate([np.diff(r) for _, r in parts]) if parts else np.zeros(0, int)
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers.reshape(-1) + 1
        owners: dict[bytes, set[int]] = defaultdict(set)
        at = 0
        for item, count in enumerate(counts.tolist()):
            own = numbers[at : at + count].astype(np.int64)
            at += count
            for k in range(max(1, count - window + 1) if count else 0):
                owners[own[k : k + window].tobytes()].add(item)
        self.ids = [identity or "" for identity, _ in items]
        by_length: dict[int, list[bytes]] = defaultdict(list)
        for key in owners:
            by_length[len(key) // 8].append(key)
        self.windows, self.owners = [], []  # per length: numbers of the words; items of each window
        for keys in by_length.values():
            self.windows.append(np.array([np.frombuffer(k, np.int64) for k in keys]))
            self.owners.append([sorted(owners[k]) for k in keys])
        self.shortest = min(by_length, default=0)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of the vocabulary, else 0."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        near = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[near] == hashes, near + 1, 0)


def _runs(numbers: np.ndarray, rows: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of known words within one document that can hold a window."""
    known = np.zeros(len(numbers) + 2, bool)
    known[1:-1] = numbers > 0
    cut = np.zeros(len(numbers) + 1, bool)
    cut[rows] = True
    starts = np.flatnonzero(known[1:-1] & (~known[:-2] | cut[:-1]))
    ends = np.flatnonzero(known[1:-1] & (~known[2:] | cut[1:])) + 1
    long = ends - starts >= max(shortest, 1)
    return starts[long], ends[long]


def search_shard(
    numbers: np.ndarray, rows: np.ndarray, phrases: Phrases
) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
    """Merged spans of hit words (starts, ends) and the items that occur, by document of the shard."""
    items: list[set[int]] = [set() for _ in range(len(rows) - 1)]
    starts, ends = _runs(numbers, rows, phrases.shortest)
    nothing = np.zeros(0, np.int64)
    if not len(starts) or not phrases.windows:
        return nothing, nothing, items
    sigma = len(phrases.vocabulary) + 1  # the last symbol parts the runs and is in no phrase
    lengths = ends - starts + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    source = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    text = np.where(source < np.repeat(ends, lengths), numbers[np.minimum(source, len(numbers) - 1)], sigma)
    index = FMIndex(text, sigma)
    cover = np.zeros(len(numbers) + 1, np.int64)
    for windows, owners in zip(phrases.windows, phrases.owners, strict=True):
        low, high = index.search(windows)
        found = np.flatnonzero(high > low)
        count = high[found] - low[found]
        row = np.repeat(low[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        at = source[index.locate(row)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + windows.shape[1], -1)
        pairs = np.unique(np.stack([np.searchsorted(rows, at, "right") - 1, np.repeat(found, count)]), axis=1)
        for document, window in pairs.T.tolist():
            items[document].update(owners[window])
    hit = np.zeros(len(numbers) + 2, bool)
    hit[1:-1] = np.cumsum(cover)[:-1] > 0
    cut = np.zeros(len(numbers) + 1, bool)
    cut[rows] = True
    return (
        np.flatnonzero(hit[1:-1] & (~hit[:-2] | cut[:-1])),
        np.flatnonzero(hit[1:-1] & (~hit[2:] | cut[1:])) + 1,
        items,
    )


def _scan(column, phrases: Phrases, shard_words: int):
    """Per document of a text column: words, merged spans of hit words, items."""
    hashes, counts = [], []

    def flush():
        known = phrases.numbers(np.concatenate(hashes))
        rows = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        starts, ends, items = search_shard(known, rows, phrases)
        first = np.searchsorted(starts, rows)
        for i in range(len(rows) - 1):
            s, e = starts[first[i] : first[i + 1]] - rows[i], ends[first[i] : first[i + 1]] - rows[i]
            yield int(rows[i + 1] - rows[i]), s, e, sorted({phrases.ids[k] for k in items[i]})

    size = 0
    for _, _, data, offsets in textcore.slices(column):
        h, r = textcore.words(data, offsets)
        hashes.append(h)
        counts.append(np.diff(r))
        size += len(h)
        if size >= shard_words:
            yield from flush()
            hashes, counts, size = [], [], 0
    if counts:
        yield from flush()


def write_groups(
    benchmark: DataFrame, item_id: str, text: str, window: int, group_words: int
) -> list[str]:
    """Names of the files with the phrases of each group; none for a benchmark without texts."""
    items = benchmark.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")
    )
    size = items.agg(F.sum(F.floor(F.length("t") / 2) + 1)).first()[0] or 0
    groups = -(-size // group_words)
    if not groups:
        return []
    spark = benchmark.sparkSession
    folder = shared_dir(spark, "phrases")

    def write(group: pa.Table) -> pa.Table:
        rows = zip(group.column("i").to_pylist(), group.column("t").to_pylist(), strict=True)
        return pa.table({"uri": [files.write(folder, "phrases", [pickle.dumps(Phrases(list(rows), window))])]})

    dealt = items.withColumn("g", F.pmod(F.xxhash64("i", "t"), F.lit(groups)))
    written = stored(dealt.groupBy("g").applyInArrow(write, "uri string"), "phrase-files")
    return sorted(row.uri for row in written.collect())


@lru_cache(maxsize=1)
def _load(uri: str) -> Phrases:
    return pickle.loads(files.read(uri))  # written by write_groups


def search(
    packed: DataFrame,
    benchmark: DataFrame,
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    group_words: int = GROUP_WORDS,
    keep_text: bool = False,
) -> DataFrame:
    """Packed documents (``frames.pack``) with n_words, merged ``spans`` of hit words and ``items``."""
    uris = write_groups(benchmark, item_id, item_text, window, group_words)
    kept = ["row", "text"] if keep_text else ["row"]
    schema = T.StructType([*[packed.schema[name] for name in kept], *T.StructType.fromDDL(ADDED).fields])
    names = schema.names
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[set[str]] = [set() for _ in range(batch.num_rows)]
            for phrases in map(_load, uris) if uris else [Phrases([], window)]:
                n = []
                for i, (count, s, e, found) in enumerate(_scan(batch.column("text"), phrases, shard_words)):
                    n.append(count)
                    spans[i] += [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)]
                    items[i].update(found)
            columns = [batch.column(name) for name in kept]
            columns += [
                pa.array(n, pa.int64()),
                pa.array(spans if len(uris) < 2 else map(merged, spans), span_type),
                pa.array([sorted(own) for own in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed.mapInArrow(scan, schema)


def find(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None, **options
) -> DataFrame:
    """The ``keep`` columns (default: all) with n_words, spans of hit words and items.

    ``spans`` are merged word positions [start, end); ``items`` the distinct ids, sorted as strings.
    """
    keep = docs.columns if keep is None else keep
    found = search(frames.pack(docs, text, keep), benchmark, keep_text=text in keep, **options)
    return frames.unpack(found, text, keep, n_words=F.col("n_words"), spans=F.col("spans"), items=F.col("items"))


def merged(spans: list[dict]) -> list[dict]:
    """Overlapping or touching spans as one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def contamination(found: DataFrame) -> DataFrame:
    """``find``'s rows with n_hit and the rule: hit at all and a twentieth of the words or more."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that the rule leaves, with their own columns and whole texts."""
    found = search(frames.pack(docs, text), benchmark, keep_text=True, **options)
    return frames.unpack(contamination(found).where(~F.col("contaminated")), text, docs.columns)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"]))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP6_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select distinct item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
p as (
  select item_id, least(13, len(ws)) as m, unnest(list_transform(range(1, greatest(len(ws) - 13, 0) + 2),
    lambda i: array_to_string(ws[i:i + 12], ' '))) as phrase from b where len(ws) > 0),
lengths as (select distinct m from p),
d as (
  select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from w cross join lengths where len(ws) >= m),
hits as (
  select d.doc_id, d.i, d.m, p.item_id from d join p on p.m = d.m and array_to_string(d.ws[d.i:d.i + d.m - 1], ' ') = p.phrase),
covered as (
  select doc_id, count(distinct i + k) as n_hit from hits, unnest(range(0, m)) as t(k) group by doc_id),
found as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from hits group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from w left join covered using (doc_id) left join found using (doc_id)
"""
