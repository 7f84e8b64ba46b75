"""The article feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv

FEED_FIELDS = (
    "date_published",
    "headline",
    "description",
    "summary",
    "corp",
    "exchange",
    "symbol",
    "prediction",
)


def article_wide(
    articles: DataFrame,
    summaries: DataFrame,
    companies: DataFrame,
    tickers: DataFrame,
    predictions: DataFrame,
) -> DataFrame:
    """The article with all its stage results; all joins are on the unique id."""
    return (
        articles.select("id", "date_published", "headline", "description")
        .join(summaries.select("id", "summary"), "id", "left")
        .join(companies.select("id", "corp"), "id", "left")
        .join(tickers.select("id", "symbol", "exchange"), "id", "left")
        .join(predictions.select("id", "prediction"), "id", "left")
    )


def feed_articles(
    articles: DataFrame,
    summaries: DataFrame,
    companies: DataFrame,
    tickers: DataFrame,
    predictions: DataFrame,
    as_of: date,
    days: int = fv.FEED_WINDOW_DAYS,
    newest_first: bool = True,
) -> DataFrame:
    """Predicted articles published from ``days`` before ``as_of`` (inclusive).

    The date filter is applied before the joins, so they touch a week of
    articles, and an article without a prediction row is not in the feed.
    """
    recent = articles.where(
        F.col("date_published") >= F.date_sub(F.lit(as_of), days).cast("timestamp")
    )
    predicted = recent.join(predictions.select("id"), "id", "left_semi")
    feed = article_wide(predicted, summaries, companies, tickers, predictions).select(
        "id", *FEED_FIELDS
    )
    return feed.orderBy(F.desc("date_published"), F.asc("id")) if newest_first else feed


def feed_cards(feed: DataFrame) -> DataFrame:
    """``EXCHANGE:SYMBOL`` and a readable time for each feed row."""
    return feed.select(
        "id",
        F.concat_ws(":", "exchange", "symbol").alias("listing"),
        F.date_format("date_published", "d MMM yyyy, h:mm a").alias("published"),
        "headline",
        "description",
        "summary",
        "prediction",
    )


def to_extended_json(feed: DataFrame) -> DataFrame:
    """Feed rows as extended JSON text; NULL fields are left out."""
    body = F.struct(
        F.struct(F.col("id").cast("string").alias("$oid")).alias("_id"),
        F.struct(
            F.date_format("date_published", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("$date")
        ).alias("date_published"),
        *[F.col(c) for c in FEED_FIELDS if c != "date_published"],
    )
    return feed.select("id", F.to_json(body).alias("json"))
