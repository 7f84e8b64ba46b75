from datetime import date, datetime

from pyspark.sql import functions as F

from newslens.operators import feed, merge, stages


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_in_an_update_overwrites_and_other_columns_stay(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, p string, q string")
    upd = spark.createDataFrame([(1, None), (3, "n")], "id long, p string")
    once = merge.partial_update(base, upd, ["id"])
    assert rows(once) == [(1, None, "x"), (2, "b", "y"), (3, "n", None)]
    assert rows(merge.partial_update(once, upd, ["id"])) == rows(once)


def test_update_without_insert(spark):
    base = spark.createDataFrame([(1, "a")], "id long, p string")
    upd = spark.createDataFrame([(1, "b"), (2, "c")], "id long, p string")
    assert rows(merge.partial_update(base, upd, ["id"], insert=False)) == [(1, "b")]


def test_upsert_last_write_wins_and_hot_key(spark):
    base = spark.createDataFrame([("h", 0)], "headline string, v long")
    upd = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "h").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("headline"),
        F.col("id").alias("v"),
        F.col("id").alias("seq"),
    )
    once = merge.upsert(base, upd, ["headline"], ["seq"])
    got = {r.headline: r.v for r in once.collect()}
    assert got["h"] == 2997 and len(got) == 8
    assert rows(merge.upsert(once, upd, ["headline"], ["seq"])) == rows(once)


def test_rows_without_isin_are_one_row(spark):
    base = spark.createDataFrame([(None, "old"), ("I1", "one")], "isin string, name string")
    upd = spark.createDataFrame(
        [(None, "n1", 1), (None, "n2", 2), ("I2", "two", 3)], "isin string, name string, seq long"
    )
    out = merge.upsert(base, upd, ["isin"], ["seq"], null_safe=True)
    assert rows(out) == sorted([(None, "n2"), ("I1", "one"), ("I2", "two")], key=repr)


def test_distinct_by_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "id long, o long, v string")
    assert rows(merge.distinct_by_key(df, ["id"], ["o"])) == [(1, 1, "a"), (2, 1, "c")]


ARTICLES = "id long, headline string, description string, topic string, topic_url_path string, text string, date_published timestamp"


def articles(spark):
    midnight, noon = datetime(2024, 1, 7), datetime(2024, 1, 7, 12)
    return spark.createDataFrame(
        [
            (1, "h1", "d1", "A", "/stream/a", "t", midnight),
            (2, "h2", "d2", "B", "/stream/b", "t", noon),
            (3, "h3", "d3", "C", "/streams", "t", noon),
            (4, "h4", "d4", "D", "/world/stream", "t", noon),
        ],
        ARTICLES,
    )


def test_open_range_skips_both_ends(spark):
    inside = stages.within(F.col("date_published"), date(2024, 1, 7), date(2024, 1, 8))
    assert rows(articles(spark).where(inside).select("id")) == [(2,), (3,), (4,)]


def test_company_stage_needs_a_summary_and_the_prefix(spark):
    summaries = spark.createDataFrame([(1, "s"), (3, "s"), (4, "s")], "id long, summary string")
    companies = spark.createDataFrame([(3, "")], "id long, corp string")
    out = stages.pending_companies(articles(spark), summaries, companies)
    assert rows(out.select("id")) == [(1,)]


def test_unmatched_article_is_done_unless_retried(spark):
    companies = spark.createDataFrame([(2, "B"), (3, ""), (4, "D")], "id long, corp string")
    tickers = spark.createDataFrame([(2, None, None)], "id long, symbol string, exchange string")
    lo, hi = date(2024, 1, 7), date(2024, 1, 8)
    args = (articles(spark), companies, tickers, lo, hi)
    assert rows(stages.pending_tickers(*args)) == [(4, "D")]
    assert rows(stages.pending_tickers(*args, retry_unmatched=True)) == [(2, "B"), (4, "D")]


def test_null_prices_are_not_trainable(spark):
    prices = spark.createDataFrame([(1, None), (2, [1.0])], "id long, prices array<double>")
    summaries = spark.createDataFrame([], "id long, summary string")
    assert rows(stages.trainable_articles(articles(spark), summaries, prices).select("id")) == [(2,)]


def test_prices_are_refetched_for_every_newer_article(spark):
    tickers = spark.createDataFrame([(1, "A", "X"), (2, "B", "X")], "id long, symbol string, exchange string")
    assert rows(stages.pending_prices(articles(spark), tickers, date(2024, 1, 7)).select("id")) == [(2,)]


def test_feed_keeps_the_first_midnight_and_sorts_newest_first(spark):
    empty = {
        "summaries": spark.createDataFrame([], "id long, summary string"),
        "companies": spark.createDataFrame([], "id long, corp string"),
        "tickers": spark.createDataFrame([(1, "A", "NYSE")], "id long, symbol string, exchange string"),
        "predictions": spark.createDataFrame(
            [(1, "rise"), (2, "fall"), (3, "fall")], "id long, prediction string"
        ),
    }
    out = feed.feed_articles(articles(spark), **empty, as_of=date(2024, 1, 14))
    assert [r.id for r in out.collect()] == [2, 3, 1]
    card = {r.id: r for r in feed.feed_cards(out).collect()}
    assert card[1].listing == "NYSE:A" and card[1].published == "7 Jan 2024, 12:00 AM"
    json = {r.id: r.json for r in feed.to_extended_json(out).collect()}
    assert json[1].startswith('{"_id":{"$oid":"1"},"date_published":{"$date":"2024-01-07T00:00:00Z"}')
    assert "symbol" not in json[2]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "articles")
    articles(spark).write.parquet(path)
    df = spark.read.parquet(path).where(stages.under_path(F.col("topic_url_path"))).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(topic_url_path,/stream)" in plan
    assert "ReadSchema: struct<id:bigint,topic_url_path:string>" in plan


def test_bucketed_stage_tables_join_without_a_shuffle(spark):
    from newslens.sources.tables import save_bucketed

    save_bucketed(articles(spark).select("id", "headline", "text"), "b_articles", "id", 4)
    save_bucketed(spark.createDataFrame([(1, "s")], "id long, summary string"), "b_summaries", "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = stages.pending_summaries(spark.table("b_articles"), spark.table("b_summaries"))
        assert rows(todo.select("id")) == [(2,), (3,), (4,)]
        assert "Exchange" not in todo._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
