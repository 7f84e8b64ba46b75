"""Exact search of the k largest inner products by cover trees of queries and data.

Rows are put into cells around a bounded number of pivots; a cell is cut into blocks of bounded
size by a hash. A task holds a block of data and a block of queries, builds a cover tree of each
and descends both together. First every query searches its home cell, which gives a lower bound
of its kth score; then it goes to those blocks of other cells whose ball may hold a better one.
Each task returns k rows a query; a window keeps the best.

Defined results: a vector that is null, empty or holds a null or non-finite component takes no
part; vectors of different length are not compared; a row is not its own neighbour, nor is a
row of the same id; repeated rows (same id and vector) count once; null ids take no part; ties go
to the smaller id. Products are exact below 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm import cover_tree, frames
from newslens.llm.jaccard_join import _groups
from newslens.settings import stored

PIVOTS = 64
BLOCK = 8192
QUERY_BLOCK = 2048
SEGMENTS = 64  # at least, if there are as many blocks
SEGMENT_ROWS = 65_536


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """id and v: floor(scale * x) of every component, x as double; only vectors that take part."""
    x = F.transform(F.col(frames.quoted(embedding)), lambda c: c.cast("double"))
    rows = vectors.select(F.col(frames.quoted(vec_id)).cast("long").alias("id"), x.alias("x"))
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(usable)
    return rows.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v")).distinct()


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """id, v, dims, cell (nearest pivot of the same length) and distance to it."""

    def assign(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table.column("dims").to_numpy()
            for n in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == n))
                v, p = _matrix(part.column("v")), pivots[n]
                square = np.maximum((v**2).sum(1)[:, None] + (p**2).sum(1) - 2 * (v @ p.T), 0)
                cell = square.argmin(1)
                far = np.sqrt(((v - p[cell]) ** 2).sum(1))
                part = part.append_column("cell", pa.array(cell.astype(np.int32))).append_column("far", pa.array(far))
                yield from part.to_batches()

    return rows.mapInArrow(assign, "id long, v array<double>, dims int, cell int, far double")


def _blocks(data: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best of every query in the blocks it asks for, for each segment.

    ``data`` has dims, segment, block; ``asked`` the queries with dims, segment, part, floor and the ``blocks`` of this
    segment. A task gets the blocks of a segment, once, and then the queries, a part at a time.
    """
    wanted = asked.select("dims", F.explode("blocks").alias("block")).distinct()
    nothing = [F.lit(0).alias("part"), F.lit(0.0).alias("floor"), F.array().cast("array<int>").alias("blocks")]
    columns = ["dims", "segment", "asks", "part", "block", "blocks", "id", "v", "floor"]
    points = data.join(wanted, ["dims", "block"], "left_semi").select("*", F.lit(0).alias("asks"), *nothing)
    queries = asked.withColumns({"asks": F.lit(1), "block": F.lit(0)})
    keys = ["dims", "segment"]
    both = points.select(columns).unionByName(queries.select(columns))
    dealt = both.repartition(*keys).sortWithinPartitions(*columns[:5])

    def work(batches):
        at, trees = None, {}
        for table in _groups(batches, columns[:5]):
            where = tuple(table.column(c)[0].as_py() for c in keys)
            if at != where:
                at, trees = where, {}
            v, ids = _matrix(table.column("v")), table.column("id").to_numpy()
            if not table.column("asks")[0].as_py():
                trees[table.column("block")[0].as_py()] = cover_tree.Tree(v), ids
                continue
            blocks = table.column("blocks").combine_chunks()
            row = np.repeat(np.arange(len(ids)), pc.list_value_length(blocks).to_numpy())
            block, floor = blocks.flatten().to_numpy(), table.column("floor").to_numpy()
            best, whole = cover_tree.Best(len(ids), k, floor), None
            for name, (tree, of) in trees.items():
                some = row[block == name]
                if len(some) == len(ids):
                    whole = whole or cover_tree.Tree(v)
                    cover_tree.search(whole, ids, tree, of, k, floor, best)
                elif len(some):
                    own = cover_tree.Best(len(some), k, floor[some])
                    own.score, own.id = best.score[some], best.id[some]
                    cover_tree.search(v[some], ids[some], tree, of, k, own.floor, own)
                    best.score[some], best.id[some] = own.score, own.id
            found = np.isfinite(best.score)
            names = np.broadcast_to(ids[:, None], found.shape)[found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(best.id[found]), pa.array(best.score[found].astype(np.int64))],
                names=["query_id", "vec_id", "score"],
            )

    return dealt.mapInArrow(work, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    pivots: int = PIVOTS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of every query. ``is_query`` speaks of column ``id``."""
    rows = stored(quantised(vectors, vec_id, embedding, scale).withColumn("dims", F.size("v")), "vectors")
    spark = vectors.sparkSession
    order = Window.partitionBy("dims").orderBy(F.xxhash64("v"), "id")
    picked = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= pivots)
    chosen: dict[int, list] = {}
    for row in picked.select("dims", "v").collect():  # ``pivots`` rows per length at most
        chosen.setdefault(row.dims, []).append(row.v)
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centers = {n: np.array(v) for n, v in chosen.items()}
    celled = stored(_cells(rows, centers), "cells")
    balls = celled.groupBy("dims", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    ball = {n: [] for n in centers}  # at most ``pivots`` per length
    total = 0
    for r in sorted(balls, key=lambda r: (r.dims, r.cell)):  # with the numbers of its first block and of blocks
        ball[r.dims].append((r.cell, r.radius, total, -(-r.n // block)))
        total += ball[r.dims][-1][-1]
    segments = min(total, max(SEGMENTS, -(-sum(r.n for r in balls) // SEGMENT_ROWS)))
    key = F.concat_ws(":", F.col("dims").cast("string"), F.col("cell").cast("string"))

    def of_cell(k: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for n, cells in ball.items() for c in cells for x in (f"{n}:{c[0]}", c[k])]), key)

    number = of_cell(2) + F.pmod(F.xxhash64("id", "v"), of_cell(3)).cast("int")
    data = celled.withColumn("block", number).withColumn("segment", F.col("block") % segments).drop("far")
    queries = celled.where(is_query)
    parts = max(1, -(-queries.count() // query_block))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int"))
    own = F.sequence(of_cell(2), of_cell(2) + of_cell(3) - 1)
    home = queries.withColumn("all", own).withColumn("segment", F.explode(F.array_distinct(F.transform("all", lambda n: n % segments))))
    home = home.withColumn("blocks", F.filter("all", lambda n: n % segments == F.col("segment")))
    home = home.withColumn("floor", F.lit(float("-inf")))
    first = stored(_blocks(data, home, k), "home")
    floors = (
        _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    )
    with_floor = queries.join(floors, "id", "left").fillna(float("-inf"), ["floor"])

    def route(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table.column("dims").to_numpy()
            for n in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == n))
                v, floor = _matrix(part.column("v")), part.column("floor").to_numpy()
                own, norm = part.column("cell").to_numpy(), np.sqrt((v**2).sum(1))
                cell, radius, first, count = (np.array(x) for x in zip(*ball[n], strict=True))
                c = centers[n][cell]
                limit = v @ c.T + norm[:, None] * radius
                slack = 1e-9 * (1 + norm[:, None] * np.sqrt((c**2).sum(1)))
                some = (limit + slack >= floor[:, None]) & (own[:, None] != cell)
                numbers = np.concatenate([np.arange(a, a + b) for a, b in zip(first, count)])
                of = np.repeat(np.arange(len(cell)), count)
                for segment in np.unique(numbers % segments).tolist():
                    here = np.flatnonzero(numbers % segments == segment)
                    wanted = some[:, of[here]]
                    sent = wanted.any(1)
                    if sent.any():
                        lists = np.append(0, np.cumsum(wanted[sent].sum(1)))
                        values = np.broadcast_to(numbers[here], wanted[sent].shape)[wanted[sent]]
                        blocks = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(values, pa.int32()))
                        out = part.filter(pa.array(sent)).drop_columns(["cell"])
                        out = out.append_column("segment", pa.array(np.full(out.num_rows, segment, np.int32)))
                        yield from out.append_column("blocks", blocks).to_batches()

    routed = with_floor.select("id", "v", "dims", "cell", "part", "floor").mapInArrow(
        route, "id long, v array<double>, dims int, part int, floor double, segment int, blocks array<int>"
    )
    second = _blocks(data, stored(routed, "routes"), k)
    return _best(first.unionByName(second), k).select("query_id", "rank", "vec_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


OP1_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
