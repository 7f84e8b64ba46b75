from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from newslens.operators import prices

BAR = "date date, open double, adjusted_close double"


def priced(spark, rows):
    return spark.createDataFrame(
        rows, f"id long, date_published date, prices array<struct<{BAR}>>"
    )


def bar(day, opened, closed):
    return (date(2024, 1, day), float(opened), float(closed))


def test_equally_near_bars_give_two_rows_and_latest_gives_one(spark):
    df = priced(spark, [(1, date(2024, 1, 1), [bar(7, 10, 9), bar(9, 10, 11)])])
    both = prices.forward_label(df).orderBy("future_price.date").collect()
    assert [r.label for r in both] == ["fall", "rise"]
    latest = prices.forward_label(df, tie="latest").collect()
    assert [(r.future_price.date, r.label) for r in latest] == [(date(2024, 1, 9), "rise")]
    with pytest.raises(ValueError):
        prices.forward_label(df, tie="first")


def test_label_compares_with_first_of_array_as_given_and_equality_falls(spark):
    unsorted = priced(spark, [(1, date(2024, 1, 1), [bar(20, 5, 1), bar(8, 1, 5)])])
    row = prices.forward_label(unsorted).first()
    assert (row.current_price.open, row.future_price.date, row.label) == (5.0, date(2024, 1, 8), "fall")


def test_nearest_may_be_the_first_bar_and_empty_arrays_drop_out(spark):
    df = priced(
        spark,
        [(1, date(2024, 1, 1), [bar(1, 2, 3)]), (2, date(2024, 1, 1), []), (3, date(2024, 1, 1), None)],
    )
    rows = prices.forward_label(df).collect()
    assert [(r.id, r.label) for r in rows] == [(1, "rise")]


def test_window_is_inclusive_on_both_ends_and_null_when_empty(spark):
    articles = spark.createDataFrame(
        [(1, "A", date(2024, 1, 10)), (2, "B", date(2024, 1, 10)), (3, None, date(2024, 1, 10))],
        "id long, ticker string, date_published date",
    )
    days = [date(2024, 1, 9), date(2024, 1, 10), date(2024, 2, 7), date(2024, 2, 8)]
    bars = spark.createDataFrame(
        [("A", d, 1.0, 1.0) for d in days], f"ticker string, {BAR}"
    )
    out = {r.id: r.prices for r in prices.attach_prices(articles, bars).collect()}
    assert [b.date for b in out[1]] == [days[1], days[2]]
    assert out[2] is None and out[3] is None


def test_attach_equals_brute_force_with_a_hot_ticker_before_and_after_1970(spark):
    start = date(1969, 11, 1)
    articles = [(i, "H" if i % 3 else f"T{i % 5}", start + timedelta(days=i % 97)) for i in range(400)]
    tickers = ["H", *[f"T{i}" for i in range(5)]]
    bars = [
        (t, start + timedelta(days=d), float(d), float(d + k))
        for k, t in enumerate(tickers)
        for d in range(0, 140, k + 1)
    ]
    a = spark.createDataFrame(articles, "id long, ticker string, date_published date")
    b = spark.createDataFrame(bars, f"ticker string, {BAR}")
    got = {r.id: [x.date for x in r.prices or []] for r in prices.attach_prices(a, b).collect()}
    for i, ticker, pub in articles:
        expected = sorted(d for t, d, *_ in bars if t == ticker and pub <= d <= pub + timedelta(days=28))
        assert got[i] == expected


def test_daily_bars(spark):
    ticks = spark.createDataFrame(
        [("A", "2024-01-01 10:00:00", 2.0, 1, 5), ("A", "2024-01-01 09:00:00", 1.0, 0, 5),
         ("A", "2024-01-01 11:00:00", 1.5, 2, 5)],
        "ticker string, ts string, price double, n long, qty long",
    )
    row = prices.daily_bars(
        ticks, "ticker", F.col("ts").cast("timestamp"), "price", F.col("n"), F.col("qty")
    ).first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (1.0, 2.0, 1.0, 1.5, 15)


def test_attach_shuffles_articles_once_and_never_groups_them(spark):
    articles = spark.range(10).selectExpr("id", "'A' as ticker", "date'2024-01-01' as date_published")
    bars = spark.createDataFrame([("A", date(2024, 1, 2), 1.0, 1.0)], f"ticker string, {BAR}")
    df = prices.attach_prices(articles, bars)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Cartesian" not in plan


def test_request_plan(spark):
    df = spark.createDataFrame(
        [(1, "AAPL", "NASDAQ", date(2024, 1, 1)), (2, "VOD", "LSE", date(2024, 1, 1)),
         (3, "AAPL", "NASDAQ", date(2024, 1, 1))],
        "id long, symbol string, exchange string, date_published date",
    )
    plan = prices.request_plan(df)
    urls = {r.id: r.url for r in plan.collect()}
    assert urls[1].endswith("/eod/AAPL.US?fmt=json&from=2024-01-01&to=2024-01-29")
    assert "/VOD.LSE?" in urls[2]
    assert sorted(r.n_articles for r in prices.distinct_requests(plan).collect()) == [1, 2]


def test_labels_from_bars_equal_labels_from_arrays(spark):
    start = date(2024, 1, 1)
    articles = spark.createDataFrame(
        [(i, "H" if i % 3 else f"T{i % 5}", start + timedelta(days=i % 50)) for i in range(200)],
        "id long, ticker string, date_published date",
    )
    bars = spark.createDataFrame(
        [(t, start + timedelta(days=d), float(d % 7), float(d % 5)) for t in ("H", "T0", "T1") for d in range(0, 60, 2)],
        f"ticker string, {BAR}",
    )
    for tie in ("both", "latest"):
        arrays = prices.forward_label(prices.attach_prices(articles, bars), tie=tie)
        expected = sorted(map(tuple, arrays.select("id", "future_price.date", "label").collect()))
        got = prices.label_from_bars(articles, bars, tie=tie)
        assert sorted(map(tuple, got.select("id", "future_date", "label").collect())) == expected
        assert len(expected) > len({i for i, *_ in expected}) or tie == "latest"
