"""Which articles a stage has still to work on.

Progress is a set of narrow stage tables keyed by article id. A row in a stage
table means the stage ran; a NULL or empty payload in it is a result, not a gap.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv


def within(ts: Column, lo: date | datetime, hi: date | datetime) -> Column:
    """Open range: a stamp of exactly ``lo`` or ``hi`` is outside."""
    return (ts > F.lit(lo).cast("timestamp")) & (ts < F.lit(hi).cast("timestamp"))


def under_path(path: Column, prefix: str = fv.STREAM_TOPIC_PREFIX) -> Column:
    """Prefix test; reaches the Parquet scan, which a regex would not."""
    return path.startswith(prefix)


def pending_summaries(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    return articles.select("id", "headline", "text").join(
        summaries.select("id"), "id", "left_anti"
    )


def pending_companies(
    articles: DataFrame,
    summaries: DataFrame,
    companies: DataFrame,
    prefix: str = fv.STREAM_TOPIC_PREFIX,
) -> DataFrame:
    """Summarised articles under the prefix without a company row."""
    return (
        articles.where(under_path(F.col("topic_url_path"), prefix))
        .select("id", "headline", "description", "topic", "topic_url_path")
        .join(summaries.select("id", "summary"), "id")
        .join(companies.select("id"), "id", "left_anti")
    )


def pending_tickers(
    articles: DataFrame,
    companies: DataFrame,
    tickers: DataFrame,
    lo: date,
    hi: date,
    retry_unmatched: bool = False,
) -> DataFrame:
    """Articles in the open range with a company and without a ticker row.

    ``retry_unmatched`` also returns those whose last attempt found none.
    """
    done = tickers.where(F.col("symbol").isNotNull()) if retry_unmatched else tickers
    return (
        articles.where(within(F.col("date_published"), lo, hi))
        .select("id")
        .join(companies.where(F.col("corp") != "").select("id", "corp"), "id")
        .join(done.select("id"), "id", "left_anti")
    )


def pending_prices(articles: DataFrame, tickers: DataFrame, since: date) -> DataFrame:
    """Every matched article newer than ``since``; prices are refetched each run."""
    return (
        articles.where(F.col("date_published") > F.lit(since).cast("timestamp"))
        .select("id", "date_published")
        .join(tickers.select("id", "symbol", "exchange"), "id")
    )


def trainable_articles(
    articles: DataFrame, summaries: DataFrame, article_prices: DataFrame
) -> DataFrame:
    """Articles with prices; a NULL price array is not trainable."""
    priced = article_prices.where(F.col("prices").isNotNull()).select("id", "prices")
    return (
        articles.select("id", "date_published", "headline", "description")
        .join(priced, "id")
        .join(summaries.select("id", "summary"), "id", "left")
    )


def pending_predictions(
    articles: DataFrame,
    summaries: DataFrame,
    tickers: DataFrame,
    predictions: DataFrame,
    lo: date,
    hi: date,
) -> DataFrame:
    """Matched articles in the open range without a prediction row."""
    return (
        articles.where(within(F.col("date_published"), lo, hi))
        .select("id", "date_published", "headline", "description")
        .join(tickers.select("id"), "id", "left_semi")
        .join(predictions.select("id"), "id", "left_anti")
        .join(summaries.select("id", "summary"), "id", "left")
    )
