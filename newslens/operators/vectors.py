"""Nearest neighbours among dense vectors by cosine.

Vectors are grouped into cells around pivots drawn from the index itself, and
cells are cut into blocks of bounded size. A query first meets the blocks of its
nearest cell. For all other cells, queries are dealt to parts and blocks to
segments, and a unit of work is one part against one segment: a query is sent once
to each segment that holds a cell of its, never once per cell. A unit returns ``k``
rows per query, never the pairs. Identical index vectors are compared once.

``probes=None`` is exact: after the nearest cell, a query visits every cell that
the triangle inequality cannot rule out. ``probes=n`` visits the ``n`` nearest
cells only, the approximate mode. No fixed ``n`` keeps its recall as the index
grows: ``probes_for`` measures how many cells a wanted recall takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.settings import stored

PLACES = 6
_ROUNDING = 10.0**-PLACES
_SLACK = 1e-9
_DEALS = 8  # parts and segments, so that what is sent grows with the vectors; more above _MOST
_LEAST, _MOST = 2_048, 131_072  # vectors of a part or segment
_CHUNK = 1_024
_NONE = np.iinfo(np.int64).max


def _with_unit(df: DataFrame) -> DataFrame:
    """``vec`` to ``unit``. Zero vectors have no cosine and are left out."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    # The norm as a lambda's argument: as a column it would be put in and computed for every component.
    unit = F.get(F.transform(F.array(norm), lambda n: F.transform("vec", lambda x: x / n)), F.lit(0))
    return df.where(norm > 0).withColumn("unit", unit).drop("vec")


def _vector(vector: str) -> Column:
    return F.col(vector).cast("array<double>").alias("vec")


def _distinct_vectors(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``(unit, ids)``: one row per distinct vector with its ``k`` lowest keys."""
    lowest = Window.partitionBy("vec").orderBy(key)
    distinct = (
        df.select(key, _vector(vector))
        .withColumn("rank", F.row_number().over(lowest))
        .where(F.col("rank") <= k)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list(key)).alias("ids"))
    )
    return _with_unit(distinct)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _nearest_cell(pivots: np.ndarray):
    @F.pandas_udf("cell int, angle double")
    def assign(units: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in units:
            if not len(batch):
                yield pd.DataFrame({"cell": pd.Series(dtype="int32"), "angle": pd.Series(dtype="float64")})
                continue
            cosines = _matrix(batch) @ pivots.T
            cell = cosines.argmax(axis=1)
            angle = _angles(cosines[np.arange(len(cell)), cell])
            yield pd.DataFrame({"cell": cell.astype("int32"), "angle": angle})

    return assign


def _home_cell(pivots: np.ndarray, radius: np.ndarray):
    """The cell of the nearest pivot, NULL where no angle is finite."""

    @F.pandas_udf("int")
    def home(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for units in batches:
            if not len(units):
                yield pd.Series([], dtype="Int32")
                continue
            angles = _angles(_matrix(units) @ pivots.T)
            angles[:, radius < 0] = np.inf
            nearest = np.argsort(angles, axis=1, kind="stable")[:, 0]
            finite = np.isfinite(angles[np.arange(len(nearest)), nearest])
            yield pd.Series(nearest, dtype="Int32").where(finite)

    return home


def _pieces(n: int) -> int:
    return max(1, min(_DEALS, -(-n // _LEAST)), -(-n // _MOST))


def _arrow_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.unique(pc.list_value_length(rows))
    if len(lengths) > 1:
        raise ValueError("vectors must have one length")
    return np.asarray(rows.flatten(), dtype=np.float64).reshape(len(rows), -1)


def _other_cells(pivots: np.ndarray, radius: np.ndarray, probes: int | None, cells_of: list[np.ndarray]):
    """Rows with ``bound`` and ``home`` to one row per segment that holds cells to visit, told by
    bits over the segment's cells: the nearest ``probes``, or all that can hold something within
    the bound; without the home cell."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(at, _CHUNK)
                angles = _angles(_arrow_matrix(batch.column("unit")) @ pivots.T)
                angles[:, radius < 0] = np.inf
                rows = np.arange(len(angles))
                if probes is None:
                    wanted = angles - radius <= np.asarray(batch.column("bound"))[:, None] + _SLACK
                else:
                    chosen = np.argsort(angles, axis=1, kind="stable")[:, :probes]
                    wanted = np.zeros(angles.shape, bool)
                    wanted[rows[:, None], chosen] = True
                    wanted &= np.isfinite(angles)
                wanted[rows, np.asarray(batch.column("home"))] = False
                for segment, cells in enumerate(cells_of):
                    own = wanted[:, cells]
                    some = np.flatnonzero(own.any(axis=1))
                    if not len(some):
                        continue
                    sent = batch.take(pa.array(some))
                    bits = np.packbits(own[some], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[sent.column(c) for c in ("qid", "unit", "bound", "part")],
                            pa.array(np.full(len(some), segment, np.int32)),
                            pa.array([b.tobytes() for b in bits], pa.binary()),
                        ],
                        names=["qid", "unit", "bound", "part", "segment", "cells"],
                    )

    return route


def _merge(best: np.ndarray, rows: np.ndarray, found: np.ndarray) -> None:
    """Keeps the least ``k`` of a row's numbers, in place."""
    k = best.shape[1]
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    touched, start = np.unique(rows, return_index=True)
    place = np.repeat(np.arange(len(touched)), np.diff(np.append(start, len(rows))))
    rank = np.arange(len(rows)) - start[place]
    new = np.full((len(touched), k), _NONE)
    new[place[rank < k], rank[rank < k]] = found[rank < k]
    best[touched] = np.sort(np.concatenate([best[touched], new], axis=1), axis=1)[:, :k]


def _part_top(k: int, cells_of: list[np.ndarray]):
    """The ``k`` nearest of a segment for each query of a part, among the cells it visits and
    within its bound. Products in single precision tell what may be that near; only those few
    are computed in double precision and ranked."""
    unit = 10**PLACES

    def top(key, queries: pa.Table, index: pa.Table) -> pa.Table:
        types = queries.schema.field("qid").type, pa.float64(), index.schema.field("ids").type
        schema = pa.schema(list(zip(("qid", "distance", "ids"), types)))
        if not queries.num_rows or not index.num_rows:
            return schema.empty_table()
        first = pc.list_element(index.column("ids").combine_chunks(), 0)
        index = index.take(pc.sort_indices(pa.table({"f": first}), sort_keys=[("f", "ascending")], null_placement="at_start"))
        asked, units = _arrow_matrix(queries.column("unit")), _arrow_matrix(index.column("unit"))
        asked32, units32 = asked.astype(np.float32), units.astype(np.float32)
        cell = np.asarray(index.column("cell"))
        by_cell = np.argsort(cell, kind="stable")
        visited = cells_of[key[1].as_py()]
        from_, to = np.searchsorted(cell[by_cell], visited), np.searchsorted(cell[by_cell], visited, "right")
        bits = np.frombuffer(b"".join(queries.column("cells").to_pylist()), np.uint8).reshape(len(asked), -1)
        slack = _ROUNDING + (asked.shape[1] + 4) * 1.2e-7  # of rounded distances and of single precision
        bound = np.cos(np.asarray(queries.column("bound")))
        out = []
        for a in range(0, len(asked), _CHUNK):
            q, q32 = asked[a : a + _CHUNK], asked32[a : a + _CHUNK]
            limit = np.where(bound[a : a + _CHUNK] > -1, bound[a : a + _CHUNK] - slack, -np.inf)
            best = np.full((len(q), k), _NONE)
            wanted = np.unpackbits(bits[a : a + _CHUNK], axis=1, count=len(visited)).astype(bool)
            for c in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, c])
                for b in range(from_[c], to[c], _CHUNK):
                    places = by_cell[b : min(b + _CHUNK, to[c])]
                    cosines = q32[rows] @ units32[places].T
                    least = limit[rows]
                    if len(places) > k and np.isneginf(least).any():
                        free = np.isneginf(least)
                        near = np.partition(np.nan_to_num(cosines[free], nan=-2.0), -k, axis=1)[:, -k]
                        least[free] = np.where(near > -2, near - 2 * slack, -np.inf)
                    i, j = np.nonzero(~(cosines < least.astype(np.float32)[:, None]))
                    for h in range(0, len(i), 1 << 16):
                        r, p = rows[i[h : h + (1 << 16)]], places[j[h : h + (1 << 16)]]
                        exact = np.einsum("ij,ij->i", q[r], units[p])
                        distance = np.nan_to_num(unit - np.rint(exact * unit), nan=4 * unit).astype(np.int64)
                        _merge(best, r, (distance << 32) | p)
                    if len(i):
                        full = best[rows, -1] != _NONE
                        kth = 1 - (best[rows[full], -1] >> 32) / unit
                        limit[rows[full]] = np.maximum(limit[rows[full]], kth - slack)
            r, place = np.nonzero(best != _NONE)
            number = best[r, place]
            distance = np.where(number >> 32 > 2 * unit, np.nan, np.round(1.0 - (unit - (number >> 32)) / unit, PLACES))
            ids = index.column("ids").take(pa.array(number & 0xFFFFFFFF))
            qids = queries.column("qid").take(pa.array(a + r))
            out.append(pa.table([qids, pa.array(distance), ids], names=["qid", "distance", "ids"]).cast(schema))
        return pa.concat_tables(out)

    return top


def _block_top(k: int, query_type: str):
    """The ``k`` nearest of an index block for each query of a query block, as flat
    arrays: the query, the distance and the position in the index block."""

    @F.pandas_udf(f"qid array<{query_type}>, distance array<double>, slot array<int>")
    def top(
        qids: pd.Series, queries: pd.Series, units: pd.Series, firsts: pd.Series
    ) -> pd.DataFrame:
        out = []
        for ids, qs, us, lowest in zip(qids, queries, units, firsts):
            cosines = np.round(_matrix(qs) @ _matrix(us).T, PLACES)
            distances = np.round(1.0 - cosines, PLACES)
            kept = min(k, distances.shape[1])
            ties = np.broadcast_to(np.asarray(lowest), distances.shape)
            order = np.lexsort((ties, distances), axis=1)[:, :kept]
            near = np.take_along_axis(distances, order, axis=1)
            out.append((np.repeat(np.asarray(ids), kept), near.ravel(), order.ravel().astype("int32")))
        return pd.DataFrame(out, columns=["qid", "distance", "slot"])

    return top


class VectorIndex:
    """Index vectors in cells. ``fit`` brings the pivots and one line of statistics
    per cell to the driver: at most ``pivots`` vectors, whatever the table size."""

    def __init__(self, cells: DataFrame, pivots: np.ndarray, radius: np.ndarray, counts, k: int, block: int):
        self.cells, self.pivots, self.radius, self.counts = cells, pivots, radius, counts
        self.k, self.block = k, block

    @classmethod
    def fit(
        cls,
        index: DataFrame,
        key: str = "id",
        vector: str = "vector",
        k: int = 1,
        pivots: int | None = None,
        block: int = 1024,
        max_pivots: int = 4096,
    ) -> "VectorIndex":
        vectors = _distinct_vectors(index, key, vector, k)
        if pivots is None:
            pivots = int(np.sqrt(index.count())) or 1
        chosen = vectors.select("unit").orderBy(F.xxhash64("unit")).limit(min(pivots, max_pivots))
        matrix = np.array([r.unit for r in chosen.collect()], dtype=np.float64)
        assigned = vectors.withColumn("at", _nearest_cell(matrix)("unit")).select(
            "unit", "ids", F.col("at.cell").alias("cell"), F.col("at.angle").alias("angle")
        )
        cells = stored(assigned, "cells")
        radius, counts = np.full(len(matrix), -1.0), np.zeros(len(matrix), dtype=np.int64)
        for row in cells.groupBy("cell").agg(F.max("angle"), F.count("*")).collect():
            radius[row[0]], counts[row[0]] = row[1], row[2]
        return cls(cells, matrix, radius, counts, k, block)

    def _blocks_of(self, counts) -> list[int]:
        return [int(max(1, -(-int(c) // self.block))) for c in counts]

    def _index_blocks(self) -> DataFrame:
        """``(cell, block, units, firsts, slots)``; a block has about ``block`` vectors
        however many its cell has."""
        per_cell = F.array(*[F.lit(n) for n in self._blocks_of(self.counts)])
        block = F.pmod(F.xxhash64("unit"), F.get(per_cell, F.col("cell"))).cast("int")
        member = F.struct(F.get("ids", F.lit(0)).alias("first"), "ids", "unit")
        return (
            self.cells.select("cell", block.alias("block"), member.alias("m"))
            .groupBy("cell", "block")
            .agg(F.sort_array(F.collect_list("m")).alias("members"))
            .select(
                "cell",
                "block",
                F.col("members.unit").alias("units"),
                F.col("members.first").alias("firsts"),
                F.col("members.ids").alias("slots"),
            )
        )

    def _visit(self, routed: DataFrame, counts: np.ndarray) -> DataFrame:
        """``routed(qid, unit, cell)`` to ``(qid, distance, ids)``, ``k`` per query and block."""
        batches = F.array(*[F.lit(n) for n in self._blocks_of(counts)])
        batch = F.pmod(F.xxhash64("qid"), F.get(batches, F.col("cell"))).cast("int")
        packed = (
            routed.select("cell", batch.alias("batch"), "qid", "unit")
            .groupBy("cell", "batch")
            .agg(F.collect_list(F.struct("qid", "unit")).alias("queries"))
        )
        work = packed.join(self._index_blocks(), "cell")
        qid_type = routed.schema["qid"].dataType.simpleString()
        nearest = _block_top(self.k, qid_type)(
            F.col("queries.qid"), F.col("queries.unit"), F.col("units"), F.col("firsts")
        )
        found = work.select("slots", nearest.alias("near")).select(
            "slots", F.explode(F.arrays_zip("near.qid", "near.distance", "near.slot")).alias("n")
        )
        return found.select("n.qid", "n.distance", F.get("slots", F.col("n.slot")).alias("ids"))

    def _segments(self) -> tuple[Column, list[np.ndarray]]:
        """The segment of an index row, and the cells of every segment: blocks of cells in a row,
        about as many in each segment."""
        blocks = np.array(self._blocks_of(self.counts)) * (self.counts > 0)
        size = np.repeat(self.counts / np.maximum(blocks, 1), blocks)
        n = _pieces(int(self.counts.sum()))
        segment = np.minimum((np.cumsum(size) - size / 2) * n // max(size.sum(), 1), n - 1).astype(int)
        of = np.repeat(np.arange(len(blocks)), blocks)
        cells_of = [np.unique(of[segment == s]) for s in range(n)]
        first = np.cumsum(blocks) - blocks
        per_cell = F.array(*[F.lit(int(b)) for b in np.maximum(blocks, 1)])
        begin = F.array(*[F.lit(int(f)) for f in first])
        block = F.pmod(F.xxhash64("unit"), F.get(per_cell, F.col("cell"))).cast("int")
        segments = F.array(*[F.lit(int(s)) for s in segment])
        return F.get(segments, F.get(begin, F.col("cell")) + block).cast("int"), cells_of

    def _visit_others(self, bounded: DataFrame, n_queries: int, probes: int | None) -> DataFrame:
        """``bounded(qid, unit, bound, home)`` to ``(qid, distance, ids)`` of cells other than
        home, ``k`` per query and segment."""
        segment, cells_of = self._segments()
        parts = _pieces(n_queries)
        dealt = bounded.withColumn("part", F.pmod(F.xxhash64("qid", "unit"), F.lit(parts)).cast("int"))
        sent = T.StructType(
            [*[dealt.schema[c] for c in ("qid", "unit", "bound", "part")]]
            + [T.StructField("segment", T.IntegerType()), T.StructField("cells", T.BinaryType())]
        )
        queries = dealt.mapInArrow(_other_cells(self.pivots, self.radius, probes, cells_of), sent)
        index = self.cells.where(F.size("ids") > 0).select(
            "cell", "unit", "ids", segment.alias("segment"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        )
        found = T.StructType([dealt.schema["qid"], T.StructField("distance", T.DoubleType()), self.cells.schema["ids"]])
        work = _part_top(self.k, cells_of)
        by = ["part", "segment"]
        return queries.groupBy(*by).cogroup(index.groupBy(*by)).applyInArrow(work, found)

    def neighbours(
        self, queries: DataFrame, key: str = "id", vector: str = "vector", probes: int | None = None
    ) -> DataFrame:
        """``(key, rank, neighbor, distance)`` of the ``k`` nearest; ties by lower id."""
        asked = _with_unit(queries.select(F.col(key).alias("qid"), _vector(vector)))
        home = _home_cell(self.pivots, self.radius)
        routed = stored(asked.select("qid", "unit", home("unit").alias("cell")), "routes").where("cell is not null")
        counts = np.zeros(len(self.pivots), dtype=np.int64)
        for row in routed.groupBy("cell").count().collect():
            counts[row[0]] = row[1]
        best = self._ranked(self._visit(routed, counts))
        if probes is None or probes > 1:
            found = stored(best, "nearest")
            # The widest angle that can still round to the k-th distance.
            widest = F.acos(F.greatest(1 - F.col("distance") - _ROUNDING, F.lit(-1.0)))
            kth = found.where(F.col("rank") == self.k).select("qid", widest.alias("bound"))
            bounded = routed.withColumnRenamed("cell", "home").join(kth, "qid", "left").withColumn(
                "bound", F.coalesce("bound", F.lit(float(np.pi)))
            )
            others = self._ranked(self._visit_others(bounded, int(counts.sum()), probes))
            best = self._top(found.unionByName(others))
        return best.select(F.col("qid").alias(key), "rank", "neighbor", "distance")

    def probes_for(
        self, queries: DataFrame, recall: float, key: str = "id", vector: str = "vector", sample: int = 1024
    ) -> int:
        """The fewest cells to visit for that share of the true ``k`` nearest, taken from the exact
        answers of ``sample`` queries, with two standard errors added to ``recall``."""
        some = queries.where(F.col(vector).isNotNull()).select(key, vector).orderBy(F.xxhash64(key), key).limit(sample)
        asked = _with_unit(stored(some, "sample").select(F.col(key).alias("qid"), _vector(vector)))
        exact = self.neighbours(asked.select(F.col("qid").alias(key), F.col("unit").alias(vector)), key, vector)
        homes = self.cells.select("cell", F.explode("ids").alias("neighbor"))
        wanted = exact.join(homes, "neighbor").select(F.col(key).alias("qid"), "cell").collect()  # k rows a query
        units = {r.qid: r.unit for r in asked.collect()}
        if not wanted:
            return 1
        angles = _angles(np.array([units[r.qid] for r in wanted], dtype=np.float64) @ self.pivots.T)
        angles[:, self.radius < 0] = np.inf
        places = np.argsort(np.argsort(angles, axis=1, kind="stable"), axis=1)
        visited = np.sort(places[np.arange(len(wanted)), [r.cell for r in wanted]]) + 1
        share = min(recall + 2 * np.sqrt(recall * (1 - recall) / len(units)), 1.0)
        return int(visited[int(np.ceil(share * len(visited))) - 1])

    def _ranked(self, found: DataFrame) -> DataFrame:
        return self._top(found.select("qid", "distance", F.explode("ids").alias("neighbor")))

    def _top(self, found: DataFrame) -> DataFrame:
        """The best ``k`` ids per query; groups are limited before the shuffle."""
        by_query = Window.partitionBy("qid").orderBy("distance", "neighbor")
        ranked = found.select("qid", "distance", "neighbor").withColumn(
            "rank", F.row_number().over(by_query)
        )
        return ranked.where(F.col("rank") <= self.k)
