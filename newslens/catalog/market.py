"""Queries on prices and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.catalog import fixtures as fx
from newslens.catalog import register
from newslens.operators import evaluation, prices

_PRICED = fx.with_sql(fx.PRICED_ARTICLES, fx.PRICE_BARS)
_WINDOWED = fx.with_sql(fx.PRICED_ARTICLES, fx.PRICE_BARS, fx.WINDOWED)


def _attached(spark, sf_dir):
    return prices.attach_prices(fx.priced_articles(spark, sf_dir), fx.label_bars(spark, sf_dir))


@register(
    "price_bars",
    fx.with_sql(fx.PRICE_BARS)
    + "select ticker, date, open, high, low, close, adjusted_close, volume from bars",
)
def price_bars(spark, sf_dir):
    return fx.price_bars(spark, sf_dir)


@register(
    "attach_prices",
    _PRICED
    + """select a.id, a.ticker, a.date_published,
  to_json(list({'date': strftime(b.date, '%Y-%m-%d'), 'open': b.open, 'high': b.high, 'low': b.low,
    'close': b.close, 'adjusted_close': b.adjusted_close, 'volume': b.volume} order by b.date)
    filter (where b.date is not null))::varchar as prices
from priced_articles a left join bars b
  on b.ticker = a.ticker and b.date between a.date_published and a.date_published + 28
group by 1, 2, 3""",
)
def attach_prices(spark, sf_dir):
    priced = prices.attach_prices(fx.priced_articles(spark, sf_dir), fx.price_bars(spark, sf_dir))
    return priced.select("id", "ticker", "date_published", F.to_json("prices").alias("prices"))


@register(
    "explode_prices",
    _PRICED
    + """select a.id, b.date, b.open, b.adjusted_close from priced_articles a join bars b
  on b.ticker = a.ticker and b.date between a.date_published and a.date_published + 28""",
)
def explode_prices(spark, sf_dir):
    return (
        _attached(spark, sf_dir)
        .select("id", F.explode("prices").alias("bar"))
        .select("id", "bar.date", "bar.open", "bar.adjusted_close")
    )


@register("nearest_bar", _WINDOWED + "select id, date, dist::int as dist from windowed where dist = md")
def nearest_bar(spark, sf_dir):
    return _nearest(spark, sf_dir, "both")


@register(
    "nearest_bar_latest",
    _WINDOWED
    + """select id, max(date) as date, min(dist)::int as dist from windowed
where dist = md group by id""",
)
def nearest_bar_latest(spark, sf_dir):
    return _nearest(spark, sf_dir, "latest")


def _nearest(spark, sf_dir, tie):
    return prices.nearest_bars(_attached(spark, sf_dir), tie=tie).select(
        "id",
        F.col("future_price.date").alias("date"),
        F.abs(F.datediff("future_price.date", F.date_add("date_published", 7))).alias("dist"),
    )


_LABEL = """select id, date, case when adjusted_close > current_open then 'rise' else 'fall' end as label
from windowed where dist = md"""


def _labelled(spark, sf_dir):
    return prices.forward_label(_attached(spark, sf_dir)).select(
        "id", F.col("future_price.date").alias("date"), "label"
    )


@register("forward_label", _WINDOWED + _LABEL)
def forward_label(spark, sf_dir):
    return _labelled(spark, sf_dir)


@register("label_from_bars", _WINDOWED + _LABEL.replace("select id, date,", "select id, date as future_date,"))
def label_from_bars(spark, sf_dir):
    labelled = prices.label_from_bars(
        fx.priced_articles(spark, sf_dir), fx.label_bars(spark, sf_dir)
    )
    return labelled.select("id", "future_date", "label")


@register(
    "label_index",
    fx.with_sql(fx.PRICED_ARTICLES, fx.PRICE_BARS, fx.WINDOWED, f"labelled as ({_LABEL})")
    + """select label, count(*) as rows,
  (row_number() over (order by count(*) desc, label) - 1)::double as index
from labelled group by label""",
)
def label_index(spark, sf_dir):
    return evaluation.label_index(_labelled(spark, sf_dir))


_REQUESTS = fx.with_sql(
    fx.PRICED_ARTICLES,
    f"""requests as (
  select id, 'https://eodhistoricaldata.com/api/eod/S' || ticker::varchar || '.'
    || case when exchange = 'LSE' then 'LSE' else 'US' end || '?fmt=json&from='
    || strftime(date_published, '%Y-%m-%d') || '&to=' || strftime(date_published + 28, '%Y-%m-%d') as url
  from (select *, {fx._exchange_sql('ticker')} as exchange from priced_articles))""",
)


def _requests(spark, sf_dir):
    listed = fx.priced_articles(spark, sf_dir).select(
        "id",
        "date_published",
        F.concat(F.lit("S"), F.col("ticker").cast("string")).alias("symbol"),
        fx._exchange(F.col("ticker")).alias("exchange"),
    )
    return prices.request_plan(listed)


@register("price_request_plan", _REQUESTS + "select id, url from requests")
def price_request_plan(spark, sf_dir):
    return _requests(spark, sf_dir)


@register(
    "price_requests_distinct",
    _REQUESTS + "select url, count(*) as n_articles from requests group by url",
)
def price_requests_distinct(spark, sf_dir):
    return prices.distinct_requests(_requests(spark, sf_dir))


@register(
    "split_train_test",
    """select o_orderkey as id, (o_orderkey * 7919 + 13) % 1000 < 700 as training from orders""",
)
def split_train_test(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ids.withColumn("training", evaluation.in_training(F.col("id")))


@register(
    "accuracy",
    fx.with_sql(fx.RULE_PREDICTIONS)
    + """select round(avg((label = prediction)::int), 6) as accuracy, count(*) as rows
from rule_predictions""",
)
def accuracy(spark, sf_dir):
    scored = evaluation.accuracy(fx.rule_predictions(spark, sf_dir))
    return scored.select(F.round("accuracy", 6).alias("accuracy"), "rows")


@register(
    "confusion_matrix",
    fx.with_sql(fx.RULE_PREDICTIONS)
    + "select label, prediction, count(*) as rows from rule_predictions group by 1, 2",
)
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(fx.rule_predictions(spark, sf_dir))
