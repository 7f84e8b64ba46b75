"""Articles with the trades or the daily bars of the weeks after them, as streams.

:func:`join_trades` joins two streams trade by trade, within watermarks. For prices by the
day, and for trades that come in any order, :func:`log_daily_bars` is the cheaper form: a
micro-batch leaves one row per ticker and day, nothing is held as state and nothing is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.operators.prices import attach_prices
from newslens.streaming.incremental import log_batches, read_log


def join_trades(
    articles: DataFrame,
    trades: DataFrame,
    days: int = fv.PRICE_WINDOW_DAYS,
    delay: str = "1 day",
    salts: int = 1,
) -> DataFrame:
    """``articles(id, ticker, published)`` with ``trades(ticker, traded, price)`` from
    publication to ``days`` days later, inclusive; inner.

    Both watermarks bound the state: a trade is kept until no article before it
    can arrive, an article until its window has passed. Rows meet by ticker and
    calendar page of ``days`` days: a trade stands in its own page, an article in the two
    that its window touches, so every pair meets once, a row is compared with the
    rows of a page and not of all time, and a hot ticker is spread over its pages. A
    stream join cannot be split at run time: for tickers that are hot within a page, the
    articles can be spread over ``salts`` tasks, and the trades are copied to each.
    """
    page = lambda time: F.floor(F.unix_date(F.to_date(time)) / max(days, 1))
    first = page(F.col("published"))
    spread = articles.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).withColumn(
        "page", F.explode(F.array(first, first + 1))
    )
    copied = trades.withColumn("page", page(F.col("traded"))).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    a = spread.withWatermark("published", delay).alias("a")
    t = copied.withWatermark("traded", delay).alias("t")
    in_window = F.col("t.traded").between(
        F.col("a.published"), F.col("a.published") + F.expr(f"interval {days} days")
    )
    same = F.lit(True)
    for key in ("ticker", "page", "salt"):
        same = same & (F.col(f"a.{key}") == F.col(f"t.{key}"))
    return a.join(t, same & in_window).select(
        "a.id", "a.ticker", "a.published", "t.traded", "t.price"
    )


def log_daily_bars(trades: DataFrame, log: str, checkpoint: str) -> None:
    """Append the available ``trades(ticker, traded, price, seq)`` to a log of daily bars.

    ``seq`` orders a ticker's trades within a day and is unique there. A batch is combined
    before its shuffle, so a ticker with most of the trades costs no more than others.
    """

    def bars(batch: DataFrame) -> DataFrame:
        return batch.groupBy("ticker", F.to_date("traded").alias("date")).agg(
            F.min("seq").alias("first"),
            F.max("seq").alias("last"),
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
        )

    log_batches(trades, bars, log, checkpoint)


def logged_bars(spark: SparkSession, log: str) -> DataFrame:
    """One bar per ticker and day: the parts that different batches logged, put together."""
    return (
        read_log(spark, log)
        .groupBy("ticker", "date")
        .agg(
            F.min_by("open", "first").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "last").alias("close"),
        )
    )


def attach_logged_prices(
    articles: DataFrame, bars: DataFrame, days: int = fv.PRICE_WINDOW_DAYS
) -> DataFrame:
    """``articles(id, ticker, published)`` with each bar from publication to ``days`` days
    later; one row with NULLs for an article that has none."""
    priced = attach_prices(articles, bars, "published", days)
    return priced.select("id", "ticker", "published", F.explode_outer("prices").alias("bar")).select(
        "id", "ticker", "published", "bar.*"
    )


def run_to_table(joined: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all available input into a Parquet table and return it."""
    query = (
        joined.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return joined.sparkSession.read.schema(joined.schema).parquet(path)
