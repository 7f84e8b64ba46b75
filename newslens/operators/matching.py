"""Names to listed securities: TF-IDF over character n-grams, cosine, nearest first.

An exact similarity join. Each distinct name is compared only with index names
that share one of its rarest n-grams (L2 prefix filtering: Bayardo et al. 2007,
Anastasiu & Karypis 2014). Let a name's *prefix* be its n-grams in rare-first
order up to the point where the rest has less than ``t`` of the norm. Two names
whose prefixes share nothing have a cosine below ``t``, so common n-grams never
become join keys and no pair that could pass the threshold is missed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.text import char_ngrams
from newslens.operators.skew import lookup_join
from newslens.sources.tables import save_bucketed

# Similarities are compared after rounding to this many places.
PLACES = 6
_SLACK = 10**-PLACES
_BUCKET_KEYS = {"vectors": "name", "ids": "name", "weighted": "gram", "idf": "gram"}


def name_ngrams(names: DataFrame, n: int = fv.NGRAM_SIZE) -> DataFrame:
    """``(name, rows, gram, tf)`` of each distinct lower-case name.

    Names are made distinct first: however many rows repeat a name, it is cut
    once. Counting inside the name's own array needs no shuffle.
    """
    distinct = (
        names.where(F.length("name") >= n)
        .groupBy(F.lower("name").alias("name"))
        .agg(F.count("*").alias("rows"))
    )
    grams = distinct.withColumn("grams", char_ngrams(F.col("name"), n))
    counted = F.transform(
        F.array_distinct("grams"),
        lambda g: F.struct(
            g.alias("gram"),
            F.size(F.filter("grams", lambda x: x == g)).alias("tf"),
        ),
    )
    return grams.select("name", "rows", F.explode(counted).alias("g")).select(
        "name", "rows", "g.gram", "g.tf"
    )


def ngram_idf(names: DataFrame, n: int = fv.NGRAM_SIZE) -> DataFrame:
    """``(gram, df, idf)`` with ``idf = ln((m + 1) / (df + 1))``, ``m`` = all names."""
    return _idf(name_ngrams(names, n), _size(names))


def _size(names: DataFrame) -> DataFrame:
    return names.where(F.col("name").isNotNull()).agg(F.count("*").cast("double").alias("m"))


def _idf(grams: DataFrame, size: DataFrame) -> DataFrame:
    m = size.scalar()
    return (
        grams.groupBy("gram")
        .agg(F.sum("rows").alias("df"))
        .withColumn("idf", F.log((m + 1) / (F.col("df") + 1)))
    )


def _weighted(grams: DataFrame, idf: DataFrame, size: DataFrame, salted: bool = True) -> DataFrame:
    """``(name, gram, w, norm, rest)``: ``rest`` is the norm from this n-gram on, rare
    first. N-grams the index has never seen weigh ``ln(m + 1)``: they match
    nothing but count in the norm."""
    m = size.scalar()
    joined = lookup_join(grams, idf, ["gram"], ["name"]) if salted else grams.join(idf, "gram", "left")
    weighed = joined.select(
        "name",
        "gram",
        F.coalesce("df", F.lit(0)).alias("df"),
        (F.col("tf") * F.coalesce("idf", F.log(m + 1))).alias("w"),
    )
    by_name = Window.partitionBy("name")
    rare_last = by_name.orderBy(F.desc("df"), F.desc("gram")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    squared = F.col("w") * F.col("w")
    return weighed.select(
        "name",
        "gram",
        "w",
        "df",
        F.sqrt(F.sum(squared).over(by_name)).alias("norm"),
        F.sqrt(F.sum(squared).over(rare_last)).alias("rest"),
    )


def _vectors(weighted: DataFrame) -> DataFrame:
    """One row per name with its weights; an array is as long as the name at most."""
    return weighted.groupBy("name").agg(
        F.max("norm").alias("norm"),
        F.map_from_entries(F.collect_list(F.struct("gram", "w"))).alias("weights"),
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.map_entries(a),
        F.lit(0.0),
        lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0)),
    )


@dataclass(frozen=True)
class NameIndex:
    """Fitted index over security names: plain tables, saved and loaded as such."""

    ids: DataFrame  # name, id: the ids that carry a name, lowest first
    weighted: DataFrame  # name, gram, w, df, norm, rest
    idf: DataFrame  # gram, df, idf
    size: DataFrame  # m
    n: int = fv.NGRAM_SIZE
    vectors: DataFrame | None = None  # name, norm, weights, of an index that is bucketed by its join keys

    @classmethod
    def fit(cls, symbols: DataFrame, n: int = fv.NGRAM_SIZE) -> "NameIndex":
        """``symbols(id, name)``; names shorter than ``n`` have no vector."""
        grams = name_ngrams(symbols, n)
        size = _size(symbols)
        idf = _idf(grams, size)
        ids = symbols.select(F.lower("name").alias("name"), "id")
        return cls(ids, _weighted(grams, idf, size), idf, size, n)

    def save(self, path: str) -> None:
        for part in ("ids", "weighted", "idf", "size"):
            getattr(self, part).write.mode("overwrite").parquet(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, n: int = fv.NGRAM_SIZE) -> "NameIndex":
        parts = [spark.read.parquet(f"{path}/{p}") for p in ("ids", "weighted", "idf", "size")]
        return cls(*parts, n)

    def save_bucketed(self, path: str, buckets: int) -> None:
        """Save with every part bucketed by the key that :meth:`neighbours` joins it on.

        Joined with as many shuffle partitions as ``buckets``, a loaded index is never shuffled. A name that
        very many others resemble is then not split over tasks, as it is with :meth:`save`.
        """
        spark = self.size.sparkSession
        parts = {"vectors": _vectors(self.weighted), "ids": self.ids, "weighted": self.weighted, "idf": self.idf}
        for part, df in parts.items():
            table = f"newslens_saved_{uuid.uuid4().hex}"
            key = _BUCKET_KEYS[part]
            save_bucketed(df.repartition(buckets, key), table, key, buckets, f"{path}/{part}")  # a file per bucket
            spark.sql(f"DROP TABLE {table}")  # its files stay
        self.size.write.mode("overwrite").parquet(f"{path}/size")
        spark.createDataFrame([(buckets, self.n)], "buckets int, n int").write.parquet(f"{path}/about")

    @classmethod
    def load_bucketed(cls, spark: SparkSession, path: str) -> "NameIndex":
        """An index saved by :meth:`save_bucketed`, as tables of this session's catalogue."""
        buckets, n = spark.read.parquet(f"{path}/about").first()
        parts = {}
        for part, key in _BUCKET_KEYS.items():
            schema = spark.read.parquet(f"{path}/{part}").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            table = f"newslens_index_{uuid.uuid4().hex}"
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{path}/{part}') "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
            )
            parts[part] = spark.table(table)
        return cls(size=spark.read.parquet(f"{path}/size"), n=n, **parts)

    def neighbours(
        self,
        names: DataFrame,
        k: int = fv.NEIGHBOURS,
        max_distance: float = fv.DEFAULT_MAX_DISTANCE,
    ) -> DataFrame:
        """``(name, rank, neighbor, distance)`` of each distinct lower-case name.

        Neighbours have a cosine distance below ``max_distance``; ties go to the
        lower id. Names without any neighbour have no row.
        """
        least = 1.0 - max_distance
        queries = _weighted(name_ngrams(names, self.n), self.idf, self.size, salted=self.vectors is None)
        # A name whose n-grams are in every index name has no direction: no cosine.
        in_prefix = (F.col("norm") > 0) & (F.col("rest") >= (least - _SLACK) * F.col("norm"))
        seen = F.col("df") > 0
        left = queries.where(in_prefix & seen).select(F.col("name").alias("query"), "gram")
        right = self.weighted.where(in_prefix).select("name", "gram")
        pairs = left.join(right, "gram").select("query", "name").distinct()

        q = _vectors(queries.where(seen)).select(
            F.col("name").alias("query"),
            F.col("norm").alias("query_norm"),
            F.col("weights").alias("query_weights"),
        )
        cosine = F.round(
            _dot(F.col("query_weights"), F.col("weights")) / (F.col("query_norm") * F.col("norm")),
            PLACES,
        )
        # Vectors and ids are both grouped by name: this join needs no shuffle.
        vectors = _vectors(self.weighted) if self.vectors is None else self.vectors
        indexed = vectors.join(self._carriers(k), "name")
        if self.vectors is None:
            compared = lookup_join(pairs, indexed, ["name"], ["query"], "inner")
        else:
            compared = pairs.join(indexed, "name")
        close = (
            lookup_join(compared, q, ["query"], ["name"], "inner")
            .select("query", "ids", F.round(1 - cosine, PLACES).alias("distance"))
            .where(F.col("distance") < max_distance)
            .select(F.col("query").alias("name"), F.explode("ids").alias("neighbor"), "distance")
        )
        if k == 1:
            best = close.groupBy("name").agg(F.min(F.struct("distance", "neighbor")).alias("best"))
            return best.select("name", F.lit(1).alias("rank"), "best.neighbor", "best.distance")
        return _first_rows(close, "name", ["distance", "neighbor"], k).select(
            "name", "rank", "neighbor", "distance"
        )

    def _carriers(self, k: int) -> DataFrame:
        """``(name, ids)``: the ``k`` lowest ids of each name; more can never be wanted."""
        if k == 1:
            return self.ids.groupBy("name").agg(F.array(F.min("id")).alias("ids"))
        lowest = _first_rows(self.ids, "name", ["id"], k)
        return lowest.groupBy("name").agg(F.collect_list("id").alias("ids"))


def _first_rows(df: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows per key. Spark limits each group before the shuffle."""
    by_key = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(by_key)).where(F.col("rank") <= k)


def nearest_names(
    queries: DataFrame,
    index: NameIndex,
    k: int = fv.NEIGHBOURS,
    max_distance: float = fv.DEFAULT_MAX_DISTANCE,
) -> DataFrame:
    """Add ``knn``, an ``array<struct<neighbor, distance>>`` that is empty when nothing
    is near enough. ``queries`` needs a ``name`` column."""
    found = (
        index.neighbours(queries.select("name"), k, max_distance)
        .groupBy(F.col("name").alias("__name"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor", "distance"))).alias("found"))
        .select(
            "__name",
            F.transform(
                "found", lambda f: F.struct(f["neighbor"].alias("neighbor"), f["distance"].alias("distance"))
            ).alias("knn"),
        )
    )
    none = F.array().cast(found.schema["knn"].dataType)
    named = queries.withColumn("__name", F.lower("name"))
    spread_by = [c for c in queries.columns if c != "name"] or ["name"]
    return (
        lookup_join(named, found, ["__name"], spread_by)
        .withColumn("knn", F.coalesce("knn", none))
        .drop("__name")
    )


def ticker_lookup(matched: DataFrame, symbols: DataFrame) -> DataFrame:
    """Add ``symbol`` and ``exchange`` of the first neighbour; NULL without one."""
    listed = symbols.select(
        F.col("id").alias("symbol_id"), F.col("code").alias("symbol"), "exchange"
    )
    first = F.get("knn", F.lit(0))["neighbor"]
    return matched.join(listed, first == F.col("symbol_id"), "left").drop("symbol_id")


def match_tickers(
    companies: DataFrame,
    symbols: DataFrame,
    max_distance: float = fv.DEFAULT_MAX_DISTANCE,
    index: NameIndex | None = None,
) -> DataFrame:
    """``companies(id, corp)`` to ``(id, corp, symbol, exchange)``; one row each, with
    NULL symbol and exchange when no listed name is near enough."""
    index = index or NameIndex.fit(symbols)
    queries = companies.select("id", "corp", F.col("corp").alias("name"))
    matched = nearest_names(queries, index, 1, max_distance)
    return ticker_lookup(matched, symbols).select("id", "corp", "symbol", "exchange")
