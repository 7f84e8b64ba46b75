"""The chains of stages, each reading what is pending and returning new rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from newslens.ml.direction import Trained, predict_direction, train_direction_model
from newslens.operators import companies, matching, stages
from newslens.operators.prices import attach_prices, forward_label
from newslens.operators.summaries import summarize_extractive
from newslens.settings import JobSettings, stored


@dataclass(frozen=True)
class StageTables:
    """What has been done so far, one narrow table per stage, keyed by ``id``."""

    summaries: DataFrame  # id, summary
    companies: DataFrame  # id, corp
    tickers: DataFrame  # id, symbol, exchange
    article_prices: DataFrame  # id, prices
    predictions: DataFrame  # id, prediction


def summarize_pending(articles: DataFrame, done: StageTables, settings: JobSettings) -> DataFrame:
    todo = stages.pending_summaries(articles, done.summaries)
    return summarize_extractive(
        todo, min_length=settings.min_length, max_length=settings.max_length
    )


def resolve_pending(
    articles: DataFrame,
    done: StageTables,
    names: DataFrame,
    settings: JobSettings,
    similarity=None,
) -> DataFrame:
    todo = stages.pending_companies(articles, done.summaries, done.companies)
    tagged = companies.find_organisations(todo, names)
    resolved = companies.resolve_company(tagged, settings.company_threshold, similarity)
    return resolved.select("id", "corp")


def match_pending(
    articles: DataFrame,
    done: StageTables,
    symbols: DataFrame,
    lo: date,
    hi: date,
    settings: JobSettings,
    index: matching.NameIndex | None = None,
) -> DataFrame:
    todo = stages.pending_tickers(articles, done.companies, done.tickers, lo, hi)
    matched = matching.match_tickers(todo, symbols, settings.max_distance, index)
    return matched.select("id", "symbol", "exchange")


def price_pending(articles: DataFrame, done: StageTables, bars: DataFrame, since: date) -> DataFrame:
    """Prices of matched articles; refetched, so a later run fills young windows."""
    todo = stages.pending_prices(articles, done.tickers, since).where("symbol is not null")
    priced = attach_prices(todo.withColumnRenamed("symbol", "ticker"), bars)
    return priced.select("id", "prices")


def predict_pending(
    articles: DataFrame, done: StageTables, model: PipelineModel | str, lo: date, hi: date
) -> DataFrame:
    todo = stages.pending_predictions(
        articles, done.summaries, done.tickers, done.predictions, lo, hi
    )
    return predict_direction(todo, model)


def label_priced(articles: DataFrame, done: StageTables, tie: str = "both") -> DataFrame:
    """``(id, date_published, headline, description, summary, ..., label)`` of priced articles."""
    priced = stages.trainable_articles(articles, done.summaries, done.article_prices)
    return forward_label(priced, tie=tie)


def train_on_priced(articles: DataFrame, done: StageTables, **options) -> Trained:
    priced = stages.trainable_articles(articles, done.summaries, done.article_prices)
    return train_direction_model(priced, **options)


def enrich_articles(
    articles: DataFrame,
    symbols: DataFrame,
    done: StageTables,
    lo: date,
    hi: date,
    settings: JobSettings | None = None,
    similarity=None,
) -> StageTables:
    """Summaries, companies and tickers of everything pending, appended to ``done``.

    What is pending has no row in its stage table yet, so new rows are added without
    a join. They are written before the next stage reads them: no stage is computed
    twice and a lost executor costs no finished stage. ``similarity`` as in
    :func:`newslens.operators.companies.resolve_company`.
    """
    settings = settings or JobSettings()

    def after(**new: DataFrame) -> StageTables:
        tables = dict(done.__dict__)
        for name, rows in new.items():
            tables[name] = tables[name].unionByName(
                stored(rows, name), allowMissingColumns=True
            )
        return StageTables(**tables)

    done = after(summaries=summarize_pending(articles, done, settings))
    done = after(companies=resolve_pending(articles, done, symbols, settings, similarity))
    return after(tickers=match_pending(articles, done, symbols, lo, hi, settings))
