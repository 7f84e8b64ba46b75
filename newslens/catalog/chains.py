"""The prediction and the training chain, from articles on."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.catalog import fixtures as fx
from newslens.catalog import register
from newslens.catalog.models import priced_news
from newslens.catalog.relational import HI, LO
from newslens.catalog.text import chain_parts, nothing_done, ratio_sql
from newslens.plans import enrich
from newslens.settings import stored


def _enriched(spark, sf_dir):
    articles = stored(fx.articles(spark, sf_dir, names_first=True), "articles")
    symbols = fx.symbols(spark, sf_dir)
    return articles, enrich.enrich_articles(articles, symbols, nothing_done(spark), LO, HI)


@register(
    "predict_chain",
    fx.with_sql(*chain_parts(ratio_sql))
    + """select t.id, t.corp, y.code as symbol, y.exchange, true as known
from ticker_names t join articles a on a.id = t.id
left join best b on b.name = lower(t.corp) left join symbols y on y.id = b.id
where a.headline is not null and a.description is not null""",
)
def predict_chain(spark, sf_dir):
    """Summaries, companies, tickers and predictions by a model of the priced articles.
    The pending articles hold none of the words that tell a price, so only that a label was
    chosen is compared; ``predict_articles`` compares the labels themselves."""
    articles, done = _enriched(spark, sf_dir)
    news = priced_news(spark, sf_dir, articles)  # not written: texts are in the articles
    history = replace(
        nothing_done(spark),
        summaries=news.select("id", "summary"),
        article_prices=news.select("id", "prices"),
    )
    trained = enrich.train_on_priced(news.drop("prices"), history, by_id="id", seed=7)
    predicted = enrich.predict_pending(articles, done, trained.model, LO, HI)
    return (
        predicted.join(done.companies, "id")
        .join(done.tickers, "id")
        .select("id", "corp", "symbol", "exchange", F.col("prediction").isin(fv.RISE, fv.FALL).alias("known"))
    )


@register(
    "train_chain",
    fx.with_sql(
        *chain_parts(ratio_sql),
        fx.NEWS_BARS,
        """priced_articles as (
  select t.id, y.code as ticker, a.date_published::date as date_published
  from ticker_names t join articles a on a.id = t.id
  join best b on b.name = lower(t.corp) join symbols y on y.id = b.id)""",
        fx.WINDOWED,
    )
    + """select id, ticker as symbol, date as future_date,
  case when adjusted_close > current_open then 'rise' else 'fall' end as label
from windowed where dist = md""",
)
def train_chain(spark, sf_dir):
    """Summaries, companies, tickers and prices to the labelled rows that training takes."""
    articles, done = _enriched(spark, sf_dir)
    bars = fx.news_bars(spark, sf_dir)
    priced = stored(enrich.price_pending(articles, done, bars, LO), "prices")
    labelled = enrich.label_priced(articles, replace(done, article_prices=priced))
    return labelled.join(done.tickers.select("id", "symbol"), "id").select(
        "id", "symbol", F.col("future_price.date").alias("future_date"), "label"
    )
