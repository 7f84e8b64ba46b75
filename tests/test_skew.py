"""A third of the rows on one key: the joins split it, and the answers stay whole."""

from contextlib import contextmanager
from datetime import date

from pyspark.sql import functions as F

from newslens.ml import embeddings
from newslens.operators import prices
from newslens.operators.skew import lookup_join


@contextmanager
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in limits:
            spark.conf.unset(key)



def hot(spark, n=30000):
    """``n`` rows, a third of them with key 0, from many map tasks."""
    return spark.range(0, n, 1, 24).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )


def test_a_grouped_lookup_is_split_at_run_time(spark):
    facts = hot(spark)
    lookup = spark.range(0, 5000).groupBy((F.col("id") % 997).alias("key")).agg(F.sum("id").alias("v"))
    with small_skew_limits(spark):
        joined = lookup_join(facts, lookup, ["key"], ["id"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    plain = facts.join(lookup, "key", "left")
    assert sorted(map(tuple, joined.select("id", "v").collect())) == sorted(
        map(tuple, plain.select("id", "v").collect())
    )


def test_salts_copy_the_lookup_and_change_nothing(spark):
    facts, lookup = hot(spark, 3000), spark.range(0, 500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        one, many = (lookup_join(facts, lookup, ["key"], ["id"], how, salts) for salts in (1, 7))
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_prices_of_a_hot_ticker(spark):
    facts = hot(spark)
    articles = facts.select("id", F.col("key").alias("ticker"), "pad", F.lit(date(2024, 1, 3)).alias("date_published"))
    bars = spark.range(0, 997 * 30).select(
        (F.col("id") % 997).alias("ticker"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / 997).cast("int")).alias("date"),
        F.lit(1.0).alias("open"),
    )
    with small_skew_limits(spark):
        priced = prices.attach_prices(articles, bars)
        rows = priced.select("id", "pad", F.size("prices").alias("n")).collect()
        probe = prices.attach_prices(articles, bars)
        probe.collect()
        assert "skew=true" in probe._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000 and {r.n for r in rows} == {28}


def test_a_word_of_every_document(spark):
    docs = spark.range(0, 20000, 1, 24).select(
        "id", F.concat(F.lit("the w"), (F.col("id") % 50).cast("string")).alias("text")
    )
    with small_skew_limits(spark):
        weights = embeddings.tfidf(docs, "id", "text")
        rows = weights.collect()
        assert "skew=true" in weights._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 40000
    assert all(abs(r.tfidf) < 1e-9 for r in rows if r.word == "the")
