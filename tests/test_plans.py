"""The chains from crawled articles to a served feed, on a small market."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from newslens.operators import feed
from newslens.plans import enrich
from newslens.settings import JobSettings

LO, HI = date(2024, 1, 1), date(2024, 3, 1)
NAMES = ["Baker Hughes Co", "Halliburton Inc", "Tesco plc", "Sanofi SA", "Bayer AG"]


def market(spark):
    symbols = spark.createDataFrame(
        [(i, n, f"C{i}", "NYSE") for i, n in enumerate(NAMES)],
        "id long, name string, code string, exchange string",
    )
    rows = []
    for i in range(60):
        name, up = NAMES[i % 5], i % 5 < 2
        tone = "profit rises and shares gain strongly" if up else "loss widens and shares drop sharply"
        text = f"{name} reports that {tone} this quarter. Analysts of {name} say {tone} again. " * 3
        path = "/stream/x" if i % 6 else "/letters/x"
        published = datetime(2024, 1, 2, 9) + timedelta(days=i % 20)
        rows.append((i, f"{name}: {tone}", f"{tone}", name, path, text, published, "FT"))
    articles = spark.createDataFrame(
        rows,
        "id long, headline string, description string, topic string, topic_url_path string, "
        "text string, date_published timestamp, source string",
    )
    bars = spark.createDataFrame(
        [
            (f"C{k}", date(2024, 1, 1) + timedelta(days=d), 100.0, 100.0 + (d if k < 2 else -d))
            for k in range(5)
            for d in range(1, 60)
        ],
        "ticker string, date date, open double, adjusted_close double",
    )
    return symbols, articles, bars


def nothing(spark):
    return enrich.StageTables(
        summaries=spark.createDataFrame([], "id long, summary string"),
        companies=spark.createDataFrame([], "id long, corp string"),
        tickers=spark.createDataFrame([], "id long, symbol string, exchange string"),
        article_prices=spark.createDataFrame(
            [], "id long, prices array<struct<date:date,open:double,adjusted_close:double>>"
        ),
        predictions=spark.createDataFrame([], "id long, prediction string"),
    )


def test_from_articles_to_feed(spark):
    symbols, articles, bars = market(spark)
    settings = JobSettings(max_distance=0.3)
    done = enrich.enrich_articles(articles, symbols, nothing(spark), LO, HI, settings)
    assert done.summaries.count() == 60
    tickers = {r.id: r.symbol for r in done.tickers.collect()}
    assert tickers == {i: f"C{i % 5}" for i in range(60) if i % 6}

    # A second run finds nothing to do and changes nothing.
    again = enrich.enrich_articles(articles, symbols, done, LO, HI, settings)
    for name in ("summaries", "companies", "tickers"):
        one, two = (sorted(map(tuple, getattr(t, name).collect())) for t in (done, again))
        assert one == two

    priced = enrich.price_pending(articles, done, bars, LO)
    assert priced.count() == len(tickers)
    done = enrich.StageTables(**{**done.__dict__, "article_prices": priced})
    trained = enrich.train_on_priced(articles, done, by_id="id", rounds=2, seed=1)
    assert trained.accuracy() == 1.0

    predictions = enrich.predict_pending(articles, done, trained.model, LO, HI)
    expected = {i: "rise" if i % 5 < 2 else "fall" for i in tickers}
    assert {r.id: r.prediction for r in predictions.collect()} == expected

    served = feed.feed_articles(
        articles, done.summaries, done.companies, done.tickers, predictions, date(2024, 1, 20)
    )
    rows = served.collect()
    assert rows and all(r.date_published >= datetime(2024, 1, 13) for r in rows)
    assert [r.date_published for r in rows] == sorted((r.date_published for r in rows), reverse=True)
    assert all(r.corp == NAMES[r.id % 5] and r.summary for r in rows)


def test_prices_stay_null_without_bars(spark):
    symbols, articles, bars = market(spark)
    tickers = spark.createDataFrame([(1, "ZZZ", "NYSE"), (2, None, None)], "id long, symbol string, exchange string")
    done = enrich.StageTables(**{**nothing(spark).__dict__, "tickers": tickers})
    out = enrich.price_pending(articles, done, bars, LO)
    assert [(r.id, r.prices) for r in out.where(F.col("prices").isNull()).collect()] == [(1, None)]


def _exchanges_of_texts(df):
    """How many exchanges stand above each scan of texts in a plan without broadcast joins."""
    spark = df.sparkSession
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and "text:string" in line:
            at, above = depth(line), 0
            for other in reversed(lines[:i]):
                if depth(other) < at:
                    at, above = depth(other), above + ("Exchange" in other)
            found.append(above)
    return found


def test_texts_meet_names_and_prices_once_each(spark, tmp_path):
    from newslens.catalog import fixtures as fx
    from newslens.catalog import models

    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    docs = [(i, f"first {i}\nsecond\n" + "word " * (i % 7), "en", "s", 1) for i in [*range(40), 3, 4]] + [(None, "a\nb", "en", "s", 1), (41, None, "en", "s", 1)]
    table("documents", docs, "doc_id long, text string, lang string, source string, n_chars int")
    table("part", [(i, f"red n{i}") for i in [*range(5), 2]], "p_partkey long, p_name string")
    table("supplier", [(i,) for i in range(3)], "s_suppkey long")
    lines = [(i, i % 3, date(1995, 1, 1) + timedelta(days=i * 11 % 2400), 1, 1.0 * (i % 50), 1.0) for i in range(900)]
    table("lineitem", lines, "l_orderkey long, l_suppkey long, l_shipdate date, l_linenumber int, l_extendedprice double, l_quantity double")
    plain, first = (fx.articles(spark, str(tmp_path), names_first=n) for n in (False, True))
    as_rows = lambda df: sorted(map(repr, df.collect()))
    assert as_rows(plain) == as_rows(first)
    assert max(_exchanges_of_texts(first)) == 1 < max(_exchanges_of_texts(plain))
    first.write.parquet(f"{tmp_path}/articles")
    news = models.priced_news(spark, str(tmp_path), spark.read.parquet(f"{tmp_path}/articles"))
    assert max(_exchanges_of_texts(news)) == 1
    assert as_rows(news) == as_rows(models.priced_news(spark, str(tmp_path)))
    got = news.collect()
    assert all(r.summary.startswith(f"first {r.id}\n") and ("climbed" in r.summary) != ("dropped" in r.summary) for r in got if r.id != 41)
    assert any(r.prices for r in got)
