"""Price bars: building them, requesting them, attaching them, choosing one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.strings import normalize_exchange, url_encode
from newslens.operators.skew import lookup_join

BAR_FIELDS = ("date", "open", "high", "low", "close", "adjusted_close", "volume")


def daily_bars(
    ticks: DataFrame, ticker: str, ts: Column, price: str, order: Column, volume: Column
) -> DataFrame:
    """One bar per ticker and day from ticks.

    ``order`` must be unique within a ticker's day. All aggregates combine before
    the shuffle, so a ticker with most of the ticks costs no more than others.
    """
    return ticks.groupBy(F.col(ticker).alias("ticker"), F.to_date(ts).alias("date")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.max_by(price, order).alias("adjusted_close"),
        F.sum(volume).alias("volume"),
    )


def request_plan(
    articles: DataFrame,
    id_col: str = "id",
    published: str = "date_published",
    days: int = fv.PRICE_WINDOW_DAYS,
    base: str = fv.PRICE_API_BASE,
) -> DataFrame:
    """The request each matched article needs; the token is added when it is sent."""
    day = F.to_date(F.col(published))
    ticker = F.concat(F.col("symbol"), F.lit("."), normalize_exchange(F.col("exchange")))
    return articles.select(
        id_col,
        F.concat(
            F.lit(f"{base}/eod/"),
            ticker,
            F.lit(f"?fmt={fv.PRICE_API_FORMAT}&from="),
            url_encode(F.date_format(day, "yyyy-MM-dd")),
            F.lit("&to="),
            url_encode(F.date_format(F.date_add(day, days), "yyyy-MM-dd")),
        ).alias("url"),
    )


def distinct_requests(plan: DataFrame) -> DataFrame:
    """One row per request with the number of articles that share it."""
    return plan.groupBy("url").agg(F.count("*").alias("n_articles"))


def _page(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days)


def bar_pages(bars: DataFrame, days: int = fv.PRICE_WINDOW_DAYS) -> DataFrame:
    """One row per ticker and calendar page of ``days`` days, with the sorted bars of
    that page and the next: all that a window starting in the page can need.

    ``bars`` holds one row per ticker and day, so an array has at most
    ``2 * days`` entries whatever the ticker.
    """
    page = _page(F.col("date"), days)
    fields = [f for f in BAR_FIELDS if f in bars.columns]
    return (
        bars.select(
            "ticker",
            F.explode(F.array(page, page - 1)).alias("page"),
            F.struct(*fields).alias("bar"),
        )
        .groupBy("ticker", "page")
        .agg(F.sort_array(F.collect_list("bar")).alias("page_bars"))
    )


def attach_prices(
    articles: DataFrame,
    bars: DataFrame,
    published: str = "date_published",
    days: int = fv.PRICE_WINDOW_DAYS,
    id_col: str = "id",
) -> DataFrame:
    """Add ``prices``: the ticker's bars from publication to ``days`` later, both
    inclusive, by date; NULL when there are none.

    A range join as one equi join on (ticker, page): articles are shuffled once and
    never grouped, and a ticker with a third of them is split over tasks.
    """
    day = F.to_date(F.col(published))
    in_window = F.filter(
        "page_bars", lambda b: (b["date"] >= day) & (b["date"] <= F.date_add(day, days))
    )
    paged = articles.withColumn("page", _page(day, days))
    return (
        lookup_join(paged, bar_pages(bars, days), ["ticker", "page"], [id_col])
        .withColumn("prices", in_window)
        .withColumn("prices", F.when(F.size("prices") > 0, F.col("prices")))
        .drop("page", "page_bars")
    )


def _distance(bar: Column, day: Column, horizon: int) -> Column:
    return F.abs(F.datediff(bar["date"].cast("date"), F.date_add(day, horizon)))


def nearest_bars(
    priced: DataFrame,
    published: str = "date_published",
    horizon: int = fv.LABEL_HORIZON_DAYS,
    tie: str = "both",
) -> DataFrame:
    """The bar nearest to publication + ``horizon`` days, as ``future_price``.

    ``tie="both"`` keeps a row for each of two equally near bars;
    ``tie="latest"`` only the later one. Works inside the array: no shuffle.
    """
    if tie not in ("both", "latest"):
        raise ValueError(f"tie must be 'both' or 'latest', not {tie!r}")
    day = F.to_date(F.col(published))
    measured = priced.withColumn(
        "nearest_distance",
        F.array_min(F.transform("prices", lambda b: _distance(b, day, horizon))),
    )
    nearest = F.filter(
        "prices", lambda b: _distance(b, day, horizon) == F.col("nearest_distance")
    )
    if tie == "latest":
        nearest = F.slice(F.array_sort(nearest, _later_first), 1, 1)
    return measured.withColumn("future_price", F.explode(nearest)).drop("nearest_distance")


def _later_first(x: Column, y: Column) -> Column:
    return F.datediff(y["date"].cast("date"), x["date"].cast("date"))


def forward_label(
    priced: DataFrame,
    published: str = "date_published",
    horizon: int = fv.LABEL_HORIZON_DAYS,
    tie: str = "both",
) -> DataFrame:
    """Label each priced article by its nearest bar a week on.

    ``rise`` when that bar's adjusted close is above the raw open of the first
    bar of the array, in the array's own order; equality is ``fall``.
    """
    labelled = nearest_bars(priced, published, horizon, tie).withColumn(
        "current_price", F.get("prices", F.lit(0))
    )
    rises = F.col("future_price.adjusted_close") > F.col("current_price.open")
    return labelled.drop("prices").withColumn(
        "label", F.when(rises, F.lit(fv.RISE)).otherwise(F.lit(fv.FALL))
    )


def label_from_bars(
    articles: DataFrame,
    bars: DataFrame,
    published: str = "date_published",
    days: int = fv.PRICE_WINDOW_DAYS,
    horizon: int = fv.LABEL_HORIZON_DAYS,
    tie: str = "both",
    id_col: str = "id",
) -> DataFrame:
    """:func:`attach_prices` and :func:`forward_label` in one, without price arrays on
    articles: adds ``future_date`` and ``label``.

    The label depends on the ticker and the day only. It is computed once per such
    pair, found by an aggregate that combines before its shuffle, and joined back:
    the work on arrays grows with tickers and days, not with articles.
    """
    dated = articles.withColumn("__day", F.to_date(F.col(published)))
    pairs = dated.select("ticker", "__day").distinct()
    priced = attach_prices(pairs, bars, "__day", days, "__day")
    outcome = F.struct(F.col("future_price.date").alias("future_date"), "label")
    labels = (
        forward_label(priced, "__day", horizon, tie)
        .groupBy("ticker", "__day")
        .agg(F.collect_list(outcome).alias("__labels"))
    )
    return (
        lookup_join(dated, labels, ["ticker", "__day"], [id_col], "inner")
        .withColumn("__label", F.explode("__labels"))
        .select(*articles.columns, "__label.*")
    )
