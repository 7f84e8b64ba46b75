"""Join of documents on the Jaccard similarity of their word shingles, with Bayesian pruning.

1. Texts with the same set of shingles form one class (by a digest of the set); classes are
   what is joined from here on.
2. MinHash values of a class are cut into bands; classes that share a band are connected, and
   a component of this graph is a search group. Two texts of similarity s miss each other with
   probability (1 - s**4)**32, below 5e-8 at s = 0.8, and less if others connect them.
3. A group is cut into blocks of bounded size; a task compares two blocks. It compares MinHash
   values a few at a time and drops a pair as soon as the posterior probability (uniform prior)
   that its similarity reaches the threshold falls below ``tolerance``; the rest is verified
   on the exact sets. Only link counts and a spanning forest leave the task, never all pairs.
4. Components of the forests are the groups of near copies.

Defined results: words are those of ``textcore``; a text of fewer words than a shingle has one
shingle of all of them; a null or wordless text is similar to nothing and is its own group.
Repeated rows are copies of each other. Null ids are allowed. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, textcore
from newslens.llm.components import components
from newslens.llm.textcore import U64
from newslens.operators.skew import lookup_join
from newslens.settings import stored

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
BAND = 4
STEP = 8
TOLERANCE = 1e-6
BLOCK = 2048


@lru_cache(1)
def _family() -> tuple[np.ndarray, np.ndarray]:
    seeds = textcore.mix(np.arange(1, 2 * HASHES + 1).astype(U64) * U64(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | U64(1), seeds[HASHES:]


def minhash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values, one line per row; rows must not be empty."""
    out = np.empty((HASHES, len(bounds) - 1), np.uint32)
    work = np.empty(len(hashes), U64)
    for k, (a, b) in enumerate(zip(*_family(), strict=True)):
        np.multiply(hashes, a, out=work)
        np.add(work, b, out=work)
        np.right_shift(work, U64(32), out=work)
        out[k] = np.minimum.reduceat(work, bounds[:-1])
    return np.ascontiguousarray(out.T)


def bands(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of ``BAND`` values, different from band to band."""
    parts = signatures.astype(U64).reshape(len(signatures), -1, BAND)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1).astype(U64), parts.shape[:2])
    for k in range(BAND):
        key = textcore.mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


@lru_cache(16)
def fewest_matches(threshold: float, tolerance: float) -> list[int]:
    """By number of values compared (multiples of STEP): fewest matches of a pair that is kept.

    After m matches of n the posterior of the similarity is Beta(m + 1, n - m + 1).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
        term = [comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(n + 2)]
        tail = np.cumsum(term)
        out.append(int(np.searchsorted(tail[: n + 1], tolerance)))
    return out


def _shingle_sets(column, size: int):
    """Sorted distinct shingle hashes of every row, with all hashes of the slice for MinHash."""
    for _, _, data, offsets in textcore.slices(column):
        hashes, rows = textcore.words(data, offsets)
        found, bounds = textcore.shingles(hashes, rows, size)
        yield found, bounds, [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _digest(one: np.ndarray) -> bytes:
    return hashlib.md5(one.tobytes(), usedforsecurity=False).digest()


def signed(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """id, digest of the shingle set (null: no shingle) and the band keys of its MinHash values."""
    rows = docs.select(F.col(frames.quoted(doc_id)).alias("id"), F.col(frames.quoted(text)).cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("key binary, bands array<long>").fields])

    def sign(batches):
        for batch in batches:
            keys, keyed = [], []
            for found, bounds, sets in _shingle_sets(batch.column("text"), size):
                some = np.flatnonzero(np.diff(bounds))
                own = bands(minhash(found, np.concatenate([bounds[some], bounds[-1:]]))).tolist() if len(some) else []
                line = {int(row): k for k, row in enumerate(some)}
                for row, one in enumerate(sets):
                    keys.append(_digest(one) if row in line else None)
                    keyed.append(own[line[row]] if row in line else None)
            if batch.num_rows:
                columns = [batch.column("id"), pa.array(keys, pa.binary()), pa.array(keyed, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(sign, schema)


def _with_sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``members`` (of groups of two or more) with shingle set and MinHash values of their representative."""
    rows = docs.select(F.col(frames.quoted(doc_id)).alias("id"), F.col(frames.quoted(text)).cast("string").alias("text"))
    joined = members.join(rows, F.col("rep").eqNullSafe(F.col("id")))
    kept = [c for c in members.columns if c not in ("rep", "key")]
    added = T.StructType.fromDDL("shingles binary, sig binary").fields
    schema = T.StructType([*[members.schema[c] for c in kept], *added])

    def add(batches):
        for batch in batches:
            keys = batch.column("key").to_pylist()
            sets = [one for _, _, part in _shingle_sets(batch.column("text"), size) for one in part]
            right = [i for i, one in enumerate(sets) if len(one) and _digest(one) == keys[i]]
            if right:  # another text may have the same id
                columns = [batch.column(c).take(pa.array(right)) for c in kept]
                columns.append(pa.array([sets[i].tobytes() for i in right], pa.binary()))
                own = [sets[i] for i in right]
                values = minhash(np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])]))
                columns.append(pa.array([v.tobytes() for v in values], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(add, schema).dropDuplicates(["cid"])


def _candidates(a: np.ndarray, b: np.ndarray, least: list[int], same: bool):
    """Line numbers of the pairs that survive the incremental comparison of MinHash values."""
    for first in range(0, len(a), 64):
        part = a[first : first + 64]
        matches = np.zeros((len(part), len(b)), np.int32)
        for k in range(STEP):
            matches += part[:, k, None] == b[None, :, k]
        keep = matches >= least[0]
        if same:
            keep &= np.arange(len(b))[None, :] > (first + np.arange(len(part)))[:, None]
        i, j = np.nonzero(keep)
        m = matches[i, j]
        for step in range(1, len(least)):
            if not len(i):
                break
            at = slice(step * STEP, (step + 1) * STEP)
            m = m + (part[i, at] == b[j, at]).sum(1)
            ok = m >= least[step]
            i, j, m = i[ok], j[ok], m[ok]
        yield i + first, j


def _linked(sig, sets, left: np.ndarray, right: np.ndarray, same: bool, threshold: float, least: list[int]):
    """Pairs of members (positions) whose exact similarity reaches the threshold."""
    column, place = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets])
    start = np.concatenate([[0], np.cumsum(size)])
    marked = np.zeros(len(column), bool)
    for i, j in _candidates(sig[left], sig[right], least, same):
        for row in np.unique(i).tolist():
            one, others = left[row], right[j[i == row]]
            own = place[start[one] : start[one + 1]]
            marked[own] = True
            for k in range(0, len(others), 4096):
                some = others[k : k + 4096]
                count = size[some]
                ends = np.cumsum(count)
                at = np.repeat(start[some] - (ends - count), count) + np.arange(ends[-1])
                common = np.add.reduceat(marked[place[at]].astype(np.int64), ends - count)
                ok = common >= threshold * (size[one] + count - common) - 1e-9
                if ok.any():
                    yield one, some[ok]
            marked[own] = False


def _compare(table: pa.Table, threshold: float, least: list[int]) -> tuple[np.ndarray, ...]:
    """cid, root of its links in these blocks, and number of documents linked to it."""
    cid = table.column("cid").to_numpy()
    weight = table.column("size").to_numpy()
    block = table.column("block").to_numpy()
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    sig = np.stack([np.frombuffer(s, np.uint32) for s in table.column("sig").to_pylist()])
    sets = [np.frombuffer(s, U64) for s in table.column("shingles").to_pylist()]
    links, a, b = np.zeros(len(cid), np.int64), [], []
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    for one, others in _linked(sig, sets, left, right, lo == hi, threshold, least):
        links[one] += weight[others].sum()
        links[others] += weight[one]
        a.append(np.full(len(others), one))
        b.append(others)
    label = np.arange(len(cid))
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
    some = links > 0
    return cid[some], cid[label[some]], links[some]


def _groups(batches, names: list[str]):
    """Runs of equal keys in sorted batches, as tables."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = np.stack([table.column(n).to_numpy() for n in names])
        cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()
        if rest is not None:
            last = [rest.column(n)[0].as_py() for n in names]
            if last != keys[:, 0].tolist():
                yield rest
                rest = None
        for a, b in zip([0, *cuts], [*cuts, table.num_rows], strict=True):
            part = table.slice(a, b - a)
            if a == 0 and rest is not None:
                part = pa.concat_tables([rest, part])
            if b < table.num_rows:
                yield part
            else:
                rest = part
    if rest is not None:
        yield rest


def _verified(members: DataFrame, threshold: float, tolerance: float, block: int) -> DataFrame:
    """cid, root, links: what the tasks over pairs of blocks found. ``members`` has group, size_of_group."""
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = (
        members.withColumn("blocks", blocks)
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "cid", "size", "sig", "shingles",
        )
        .repartition("root", "lo", "hi")
        .sortWithinPartitions("root", "lo", "hi")
    )
    least = fewest_matches(threshold, tolerance)

    def compare(batches):
        for table in _groups(batches, ["root", "lo", "hi"]):
            cid, root, links = _compare(table, threshold, least)
            if len(cid):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid), pa.array(root), pa.array(links)], names=["u", "v", "links"]
                )

    return rows.mapInArrow(compare, "u long, v long, links long")


def near_copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (smallest id of its group of near copies) and n_links.

    ``n_links`` counts the other rows of similarity ``threshold`` or more, copies included.
    """
    rows = stored(signed(docs, doc_id, text, size), "signed")
    grouped = (
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.first("bands").alias("bands"))
    )
    classes = stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    banded = classes.select("cid", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("cid").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    near = lookup_join(banded, least, ["band"], ["cid"], "inner").select(F.col("cid").alias("u"), "v")
    search = stored(components(near).withColumnRenamed("node", "cid"), "search")
    sizes = search.groupBy("root").agg(F.count("*").alias("members"))
    members = lookup_join(search, sizes, ["root"], ["cid"], "inner").join(classes.drop("bands"), "cid")
    found = stored(
        _verified(_with_sets(docs, members, doc_id, text, size), threshold, tolerance, block), "found"
    )
    group = components(found.select("u", "v"))
    links = found.groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    info = (
        classes.select("key", "cid", "rep", "size")
        .join(links, "cid", "left")
        .join(group.select(F.col("node").alias("cid"), "root"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    info = stored(info, "info")
    smallest = info.groupBy("root").agg(F.min("rep").alias("class_id"))
    by_key = lookup_join(info, smallest, ["root"], ["cid"], "inner").select(
        "key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    named = lookup_join(rows.select("id", "key"), by_key, ["key"], ["id"], "left")
    return named.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def drop_near_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one of the smallest id. Repeated rows stay once.

    Rows that share an id are one document: they stay if one of them does.
    """
    kept = near_copies(docs, doc_id=doc_id, text=text, **options)
    kept = kept.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.struct("doc_id").alias("__kept")).distinct()
    # a struct equals another if both hold null; the join's partitioning serves the dropping of repeats
    packed = docs.select(
        F.struct(F.col(frames.quoted(doc_id)).alias("doc_id")).alias("__kept"),
        F.col(frames.quoted(text)).alias("__text"),
        F.struct(*[F.col(frames.quoted(c)) for c in docs.columns if c not in (doc_id, text)]).alias("__row"),
    )
    own = packed.join(kept, "__kept", "left_semi").dropDuplicates(["__kept", "__text"])
    columns = {doc_id: F.col("__kept.doc_id"), text: F.col("__text")}
    return own.select(*[columns.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])


def op8(spark, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
s as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(ws) - 5, 0) + 2),
    lambda i: array_to_string(ws[i:i + 4], ' '))) as sh from w where len(ws) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach as (
  select a as doc_id, b as other from links
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, least(d.doc_id, coalesce(m.low, d.doc_id)) as class_id, coalesce(k.n_links, 0)::bigint as n_links
from documents d
left join (select doc_id, min(other) as low from reach group by doc_id) m using (doc_id)
left join (select a as doc_id, count(*) as n_links from links group by a) k using (doc_id)
"""
