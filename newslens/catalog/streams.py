"""Queries that run a stream over the given tables to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.catalog import fixtures as fx
from newslens.catalog import register
from newslens.settings import shared_dir
from newslens.streaming import incremental, price_join, price_timers


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a file stream. A stream wants a folder or a pattern; the
    pattern fits a table that is one file as well as one that is a folder."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}[.]parquet")


_SEQUENCE = ["l_shipdate", "l_linenumber", "l_partkey", "o_totalprice"]


@register(
    "stream_incremental_merge",
    """with last as (
  select l_orderkey as k, arg_max(l_extendedprice, (l_shipdate, l_linenumber, l_partkey, l_extendedprice)) as p,
    arg_max(l_linestatus, (l_shipdate, l_linenumber, l_partkey, l_extendedprice)) as s
  from lineitem group by 1)
select coalesce(o_orderkey, k) as o_orderkey, o_custkey,
  case when k is not null then p else o_totalprice end as o_totalprice,
  case when k is not null then s else o_orderstatus end as o_orderstatus
from orders full join last on k = o_orderkey""",
)
def stream_incremental_merge(spark, sf_dir):
    updates = stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_linestatus").alias("o_orderstatus"),
        "l_shipdate",
        "l_linenumber",
        "l_partkey",
    )
    base = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    folder = shared_dir(spark, "updates")
    log = f"{folder}/log"
    incremental.log_updates(updates, ["o_orderkey"], _SEQUENCE, log, f"{folder}/checkpoint")
    return incremental.current(spark, base, log, ["o_orderkey"], _SEQUENCE)


@register(
    "stream_daily_prices",
    fx.with_sql(fx.PRICED_ARTICLES, fx.PRICE_BARS)
    + """select a.id, a.ticker, a.date_published as published, b.date, b.open, b.high, b.low, b.close
from priced_articles a left join bars b
  on b.ticker = a.ticker and b.date between a.date_published and a.date_published + 28""",
)
def stream_daily_prices(spark, sf_dir):
    """Trades stream in by line number, that is out of order, over several micro-batches."""
    folder = shared_dir(spark, "daily")
    trades = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"),
        F.col("l_shipdate").alias("traded"),
        F.col("l_extendedprice").alias("price"),
        fx.trade_order().alias("seq"),
        F.col("l_linenumber").alias("part"),
    )
    trades.write.partitionBy("part").parquet(f"{folder}/trades")
    landed = spark.read.parquet(f"{folder}/trades")
    batches = 4
    arriving = (
        spark.readStream.schema(landed.schema)
        .option("maxFilesPerTrigger", max(1, len(landed.inputFiles()) // batches))
        .parquet(f"{folder}/trades")
    )
    price_join.log_daily_bars(arriving.drop("part"), f"{folder}/log", f"{folder}/checkpoint")
    articles = fx.priced_articles(spark, sf_dir).withColumnRenamed("date_published", "published")
    return price_join.attach_logged_prices(articles, price_join.logged_bars(spark, f"{folder}/log"))


@register(
    "stream_attach_prices",
    """select o_orderkey as id, a.ticker, o_orderdate::date as published, l_shipdate::date as traded,
  l_extendedprice as price
from (select *, o_custkey % (select count(*) from supplier) as ticker from orders) a
join lineitem on l_suppkey = a.ticker and l_shipdate between o_orderdate and o_orderdate + to_days(28)""",
)
def stream_attach_prices(spark, sf_dir):
    n_tickers = fx.table(spark, sf_dir, "supplier").count()
    articles = stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % n_tickers).alias("ticker"),
        F.col("o_orderdate").cast("timestamp").alias("published"),
    )
    trades = stream(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"),
        F.col("l_shipdate").cast("timestamp").alias("traded"),
        F.col("l_extendedprice").alias("price"),
    )
    folder = shared_dir(spark, "trades")
    joined = price_join.join_trades(articles, trades)
    found = price_join.run_to_table(joined, f"{folder}/table", f"{folder}/checkpoint")
    return found.withColumn("published", F.to_date("published")).withColumn(
        "traded", F.to_date("traded")
    )


@register(
    "stream_timed_prices",
    fx.with_sql(fx.PRICED_ARTICLES, fx.PRICE_BARS)
    + """select a.id, a.ticker, a.date_published as published, count(b.date) as n_bars, min(b.date) as first_day,
  max(b.date) as last_day, arg_min(b.open, b.date) as first_open, arg_max(b.close, b.date) as last_close
from priced_articles a left join bars b
  on b.ticker = a.ticker and b.date between a.date_published and a.date_published + 28
group by all""",
)
def stream_timed_prices(spark, sf_dir):
    """Articles and bars land by month and arrive over several micro-batches; a last bar of no ticker, long
    after all others, lets the watermark pass every window."""
    folder = shared_dir(spark, "timed")
    articles = fx.priced_articles(spark, sf_dir).withColumnRenamed("date_published", "published")
    bars = fx.price_bars(spark, sf_dir).select("ticker", "date", "open", "high", "low", "close")
    articles.repartition(F.year("published"), F.month("published")).write.parquet(f"{folder}/articles")
    bars.repartition(F.year("date"), F.month("date")).write.parquet(f"{folder}/bars")
    end = spark.read.parquet(f"{folder}/bars").agg(F.date_add(F.max("date"), 3650 + 90).alias("date")).select(
        F.lit(-1).cast("long").alias("ticker"), "date", *[F.lit(0.0).alias(c) for c in ("open", "high", "low", "close")]
    )
    end.write.mode("append").parquet(f"{folder}/bars")
    files = {name: len(spark.read.parquet(f"{folder}/{name}").inputFiles()) for name in ("articles", "bars")}
    landed = [
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max(3, -(-files[name] // 3))).parquet(f"{folder}/{name}")
        for name, df in (("articles", articles), ("bars", bars))
    ]
    # Files come in any order, so the watermark must wait for all of them: ten years.
    priced = price_timers.attach_by_timers(*landed, delay="3650 days", salts=1)
    found = price_timers.run_with_timers(priced, f"{folder}/table", f"{folder}/checkpoint")
    first, last = F.get("prices", F.lit(0)), F.element_at("prices", -1)
    return found.select(
        "id", "ticker", "published", F.coalesce(F.size("prices"), F.lit(0)).cast("long").alias("n_bars"),
        first["date"].alias("first_day"), last["date"].alias("last_day"),
        first["open"].alias("first_open"), last["close"].alias("last_close"),
    )
