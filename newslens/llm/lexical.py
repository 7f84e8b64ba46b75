"""Ranked lexical search: all documents against a set of queries by Block-Max MaxScore over shard indexes.

Tasks cut the documents into shards of about ``shard_bytes`` and write an inverted index of each to the shared
folder: postings in blocks of 128, gaps and frequencies as narrow as each block allows, and for every block its last
document, highest frequency and shortest document. The index knows no corpus statistics, so it needs no second pass.
Spark sums the number of documents, their terms and, of the terms that queries have, the documents per term. Queries
are written in numbered groups; a task that searches holds one shard and one group at a time.

In a shard the lists of a query are taken by falling upper bound. As long as the bounds of the lists that are left can
lift a new document to the k-th best score so far, a list is essential and is read whole. After that lists are only
probed for candidates, and the bound of a candidate's block rejects it before the block is decompressed. The best of
each shard are merged by Spark, which limits them within each task before its shuffle.

Terms are known by 64-bit hashes: among a billion terms, one of 10,000 query terms meets another one with probability
below 1e-6.

Defined results: a null or empty text has no terms and is never found; a query without terms has no rows; repeated
documents are ranked each on its own, equal scores by the id, null first; equal rows of a query count once, other rows
of one query id are one query with the terms of all; a null query id is an id like any other; no rows give no rows;
other columns are ignored.
"""

from __future__ import annotations

import io
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import files, frames, textcore
from newslens.llm.wordstore import spread
from newslens.settings import shared_dir, stored

TOP = 20
BLOCK = 128
SHARD_BYTES = 1 << 25
GROUP_QUERIES = 512
SLICE_BYTES = 1 << 20
_KINDS = (np.uint8, np.uint16, np.uint32)


def weight(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def norm(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    return 75 + (25 * lengths * n) // max(total, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# --- the index of a shard --------------------------------------------------------


def _narrow(values: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Numbers of all blocks, each block as narrow as its largest one: the width of each block and a pool per width."""
    most = np.maximum.reduceat(values, first) if len(first) else values
    width = np.digitize(most, (1 << 8, 1 << 16)).astype(np.uint8)
    of = np.repeat(width, np.diff(np.concatenate([first, [len(values)]])))
    return {"width": width} | {str(k): values[of == k].astype(kind) for k, kind in enumerate(_KINDS)}


def build(ids: list, lengths: np.ndarray, terms: np.ndarray, docs: np.ndarray, tfs: np.ndarray) -> bytes:
    """The file of a shard. Postings come by document; ``docs`` number the documents from 0."""
    order = np.argsort(terms, kind="stable")
    terms, docs, tfs = terms[order], docs[order], tfs[order]
    begins = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([begins, [len(terms)]]))
    blocks = -(-sizes // BLOCK)
    before = np.cumsum(blocks) - blocks
    within = np.arange(int(blocks.sum())) - np.repeat(before, blocks)
    first = np.repeat(begins, blocks) + within * BLOCK  # posting where a block begins
    last = np.concatenate([first[1:], [len(terms)]]) - 1 if len(first) else first
    gaps = np.diff(docs, prepend=0)
    gaps[first] = 0
    parts = {
        "ids": np.array([0 if i is None else i for i in ids], np.int64),
        "known": np.array([i is not None for i in ids], bool),
        "lengths": lengths, "terms": terms[begins], "df": sizes.astype(np.int32), "blocks": before.astype(np.int32),
        "size": (last - first + 1).astype(np.uint8),
        "first": docs[first].astype(np.int32), "last": docs[last].astype(np.int32),
        "most": (np.maximum.reduceat(tfs, first) if len(first) else first).astype(np.int32),
        "shortest": (np.minimum.reduceat(lengths[docs], first) if len(first) else first).astype(np.int32),
    }
    for name, values in (("gap", gaps), ("tf", tfs)):
        parts |= {f"{name}_{k}": v for k, v in _narrow(values, first).items()}
    out = io.BytesIO()
    np.savez(out, **parts)
    return out.getvalue()


class Shard:
    """An index file with the bounds that the corpus statistics give its blocks and lists."""

    def __init__(self, data: bytes, n: int = 1, total: int = 1):
        self.__dict__ |= dict(np.load(io.BytesIO(data)))
        self.size, self.most, self.shortest = (x.astype(np.int64) for x in (self.size, self.most, self.shortest))
        self.m = norm(self.lengths, n, total)
        self.bound = impact(self.most, norm(self.shortest, n, total))
        self.list_bound = np.maximum.reduceat(self.bound, self.blocks) if len(self.blocks) else self.bound
        self.ends = np.concatenate([self.blocks, [len(self.size)]])
        self.at = {name: self._places(getattr(self, f"{name}_width")) for name in ("gap", "tf")}

    def _places(self, width: np.ndarray) -> np.ndarray:
        """Where the numbers of each block begin in the pool of its width."""
        at = np.zeros(len(width), np.int64)
        for k in range(len(_KINDS)):
            some = np.flatnonzero(width == k)
            at[some] = np.cumsum(self.size[some]) - self.size[some]
        return at

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms the shard has, and the numbers of their lists."""
        place = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        has = self.terms[place] == terms if len(self.terms) else np.zeros(len(terms), bool)
        return np.flatnonzero(has), place[has]

    def _numbers(self, name: str, blocks: np.ndarray) -> np.ndarray:
        width, size = getattr(self, f"{name}_width")[blocks], self.size[blocks]
        if (width == width[0]).all():
            return getattr(self, f"{name}_{width[0]}")[spread(self.at[name][blocks], size)].astype(np.int64)
        out, ends = np.empty(int(size.sum()), np.int64), np.cumsum(size)
        for k in range(len(_KINDS)):
            some = np.flatnonzero(width == k)
            pool = getattr(self, f"{name}_{k}")
            out[spread((ends - size)[some], size[some])] = pool[spread(self.at[name][blocks[some]], size[some])]
        return out

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, decompressed."""
        size = self.size[blocks]
        gaps = self._numbers("gap", blocks)
        begin = np.cumsum(size) - size
        docs = np.cumsum(gaps)
        docs += np.repeat(self.first[blocks] - docs[begin], size)
        return docs, impact(self._numbers("tf", blocks), self.m[docs])

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that can be among the ``k`` best. ``weights``: of each term, repeats included."""
        has, lists = self.find(terms)
        weights = weights[has]
        bounds = weights * self.list_bound[lists]
        order = np.argsort(-bounds, kind="stable")
        lists, weights = lists[order], weights[order]
        left = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])  # what this list and the later ones can add
        scores = np.zeros(len(self.ids), np.int64)
        least, turn = 1, 0
        while turn < len(lists) and left[turn] >= least:  # essential lists
            docs, gained = self.read(np.arange(self.ends[lists[turn]], self.ends[lists[turn] + 1]))
            scores[docs] += weights[turn] * gained
            turn += 1
            if turn < 3 or turn % 4 == 0:
                least = max(least, self._kth(scores, k))
        alive = np.flatnonzero(scores >= max(1, least - left[turn]))
        for t in range(turn, len(lists)):
            least = max(least, self._kth(scores[alive], k))
            alive = alive[scores[alive] + left[t] >= least]
            low, high = self.ends[lists[t]], self.ends[lists[t] + 1]
            block = low + np.searchsorted(self.last[low:high], alive)
            inside = block < high
            top = np.where(inside, weights[t] * self.bound[np.minimum(block, high - 1)], 0)
            good = scores[alive] + top + left[t + 1] >= least
            alive, block = alive[good], block[good & inside]
            if len(block):
                docs, gained = self.read(np.unique(block))
                place = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                scores[alive] += np.where(docs[place] == alive, weights[t] * gained[place], 0)
        alive = alive[scores[alive] >= max(1, self._kth(scores[alive], k))]
        return alive, scores[alive]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> int:
        return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


# --- Spark -----------------------------------------------------------------------


def index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards; a row per file: path, docs (that have terms), total (their terms)."""
    folder = shared_dir(docs.sparkSession, "lexical")
    rows = docs.select(F.col(frames.quoted(doc_id)).cast("long").alias("id"), F.col(frames.quoted(text)).cast("string").alias("text"))

    def save(batches):
        parts, ids, lengths, size = [], [], [], 0

        def flush():
            nonlocal parts, ids, lengths, size
            n = np.concatenate(lengths)
            terms, docs, tfs = (np.concatenate(x) for x in zip(*parts, strict=True))
            uri = files.write(folder, "npz", [build(ids, n, terms, docs, tfs)])
            parts, ids, lengths, size = [], [], [], 0
            return pa.RecordBatch.from_pydict({"path": [uri], "docs": [int((n > 0).sum())], "total": [int(n.sum())]})

        for batch in batches:
            for first, end, data, offsets in textcore.slices(batch.column("text"), min(SLICE_BYTES, shard_bytes)):
                hashes, bounds = textcore.words(data, offsets)
                count = np.diff(bounds)
                terms, number = np.unique(hashes, return_inverse=True)
                own = np.repeat(np.arange(len(count)), count) * max(1, len(terms)) + number
                own, tfs = np.unique(own, return_counts=True)
                parts.append((terms[own % max(1, len(terms))], own // max(1, len(terms)) + len(ids), tfs))
                ids += batch.column("id").slice(first, end - first).to_pylist()
                lengths.append(count)
                size += len(data)
                if size >= shard_bytes:
                    yield flush()
        if ids:
            yield flush()

    return stored(rows.mapInArrow(save, "path string, docs long, total long"), "lexical-shards")


def query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """query, term, n: the terms of each query and how often it has them."""
    rows = queries.select(F.col(frames.quoted(query_id)).alias("query"), F.col(frames.quoted(text)).cast("string").alias("text")).distinct()
    schema = T.StructType([rows.schema["query"], T.StructField("term", T.LongType())])

    def cut(batches):
        for batch in batches:
            for first, end, data, offsets in textcore.slices(batch.column("text"), SLICE_BYTES):
                hashes, bounds = textcore.words(data, offsets)
                of = pa.array(np.repeat(np.arange(first, end), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([batch.column("query").take(of), pa.array(hashes.view(np.int64))], names=schema.names)

    return rows.mapInArrow(cut, schema).groupBy("query", "term").agg(F.count("*").alias("n"))


def _document_counts(shards: DataFrame, terms: DataFrame) -> DataFrame:
    """term, df: of the terms that queries have, the documents of all shards that hold them."""

    def load(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with np.load(io.BytesIO(files.read(path))) as parts:
                    columns = [pa.array(parts["terms"].view(np.int64)), pa.array(parts["df"].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "df"])

    counts = files.dealt(shards.select("path")).mapInArrow(load, "term long, df long")
    return counts.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))


def _query_files(weighted: DataFrame, groups: int) -> list[str]:
    """Write the queries in numbered files; their names, one for every ``GROUP_QUERIES`` queries or so."""
    folder = shared_dir(weighted.sparkSession, "lexical-queries")
    placed = weighted.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    placed = placed.repartition(groups, "group").sortWithinPartitions("group", "query")

    def save(batches):
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        for group in rows.column("group").unique().to_pylist() if rows else []:
            own = rows.filter(pc.equal(rows.column("group"), group)).combine_chunks()
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, own.schema) as out:
                out.write_table(own)
            uri = files.write(folder, "arrow", [sink.getvalue()])
            yield pa.RecordBatch.from_pydict({"path": [uri]})

    return [r.path for r in stored(placed.mapInArrow(save, "path string"), "lexical-groups").collect()]


def _queries_of(data: bytes) -> list[tuple[pa.Scalar, np.ndarray, np.ndarray]]:
    rows = pa.ipc.open_stream(data).read_all().combine_chunks()
    if not rows.num_rows:
        return []
    query = rows.column("query").combine_chunks()
    coded = query.dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(coded)) + 1).tolist(), len(coded)]
    terms, weights = (rows.column(c).to_numpy() for c in ("term", "weight"))
    return [(query[a], terms[a:b].view(textcore.U64), weights[a:b]) for a, b in itertools.pairwise(cuts)]


def search(
    docs: DataFrame,
    queries: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    k: int = TOP,
    shard_bytes: int = SHARD_BYTES,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """The ``k`` best documents of each query with a score above 0: query_id, rank, doc_id, score."""
    shards = index(docs, doc_id=doc_id, text=text, shard_bytes=shard_bytes)
    sums = shards.agg(F.sum("docs").alias("n"), F.sum("total").alias("total")).first()
    n, total = sums.n or 0, sums.total or 0
    terms = stored(query_terms(queries, query_id, query_text), "query-terms")
    log = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1)))
    weighted = terms.join(_document_counts(shards, terms), "term").withColumn("weight", F.col("n") * log)
    groups = -(-terms.select("query").distinct().count() // group_queries) or 1
    names = _query_files(weighted.select("query", "term", "weight"), groups)
    schema = T.StructType([terms.schema["query"], *T.StructType.fromDDL("doc_id long, score long").fields])
    kind = pa.int64()

    def work(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                shard = Shard(files.read(path), n, total)
                for name in names:
                    found = [(q, *shard.search(t, w, k)) for q, t, w in _queries_of(files.read(name))]
                    found = [(q, *shard_best(shard, at, scores, k)) for q, at, scores in found if len(at)]
                    if found:
                        of = pa.array(np.repeat(np.arange(len(found)), [len(s) for _, _, s in found]))
                        column = pa.array([q.as_py() for q, _, _ in found], found[0][0].type).take(of)
                        at = np.concatenate([a for _, a, _ in found])
                        ids = pa.array(shard.ids[at], kind, mask=~shard.known[at])
                        yield pa.RecordBatch.from_arrays([column, ids, pa.array(np.concatenate([s for *_, s in found]), kind)], names=schema.names)

    best = files.dealt(shards.select("path")).mapInArrow(work, schema)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_id), "rank", F.col("doc_id"), "score")


def shard_best(shard: Shard, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((shard.ids[at], shard.known[at], -scores))[:k]
    return at[order], scores[order]


def op12(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
items as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from (select distinct item_id, text from benchmark)),
q as (select item_id, term, count(*) as qn from items group by all),
tf as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, count(*) as n from words group by doc_id),
s as (select count(*) as n_docs, sum(n)::bigint as total from lengths),
df as (select term, count(*) as df from tf where term in (select term from q) group by term),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w from df, s),
m as (select doc_id, 75 + (25 * n * n_docs) // total as m from lengths, s),
scored as (
  select item_id, doc_id, sum(qn * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from q join w using (term) join tf using (term) join m using (doc_id) group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 20
"""
