"""Tables that are updated in part, a saved index that is not shuffled, and article windows by timers."""

import os
import re
from datetime import date, timedelta

from pyspark.sql import Row
from pyspark.sql import functions as F

from newslens.operators import matching, merge
from newslens.operators.prices import attach_prices
from newslens.sources.keyed import KeyedTable
from newslens.streaming import price_timers


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_update_writes_only_its_folders(spark, tmp_path):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.col("id").alias("w"))
    table = KeyedTable.create(base, f"{tmp_path}/t", ["k"], 32)
    before = files(table.path)
    updates = spark.createDataFrame([(7, "new"), (8, None), (5000, "added"), (None, "no key")], "k long, v string")
    parts = table.update(updates)
    assert 1 < len(parts) <= 4
    gone = {re.search(r"__part=(\d+)", f)[1] for f in before - files(table.path)}
    assert gone <= set(map(str, parts)) and len(before & files(table.path)) == len(before) - len(gone)
    want = rows(merge.partial_update(base, updates, ["k"]))
    assert rows(table.read()) == want
    table.update(updates)
    assert rows(table.read()) == [*want, *[r for r in want if r[0] is None]] or rows(table.read()) == want
    assert table.update(updates.limit(0)) == [] and table.update(updates.where("k = 9999"), insert=False) == []
    twice = spark.createDataFrame([(7, "a", 1), (7, "b", 2)], "k long, v string, seq int")
    table.update(twice, insert=False, sequence=["seq"])
    assert [r.v for r in table.read().where("k = 7").collect()] == ["b"]


def test_a_saved_index_is_not_shuffled(spark, tmp_path):
    names = [f"{a} {b} company" for a in ("acme", "globex", "initech", "umbrella") for b in ("north", "south", "steel", "oil")]
    symbols = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    queries = spark.createDataFrame([(n[:-2],) for n in names] + [("zzz",), (None,), ("ab",)], "name string")
    index = matching.NameIndex.fit(symbols)
    index.save_bucketed(f"{tmp_path}/index", 8)
    loaded = matching.NameIndex.load_bucketed(spark, f"{tmp_path}/index")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = loaded.neighbours(queries, 2, 0.5)
        assert rows(found) == rows(index.neighbours(queries, 2, 0.5)) and found.count() > len(names)
        plan = found._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("== Initial Plan ==")[-1].splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
    assert len(scans) >= 4
    for i in scans:  # going up from a scan of the index, a join comes before any exchange
        at = depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < at:
                at = depth(line)
                if "Join" in line:
                    break
                assert "Exchange" not in line, line


def test_article_windows_by_timers_equal_attach_prices(spark, tmp_path):
    first = date(2024, 1, 1)
    day = lambda n: first + timedelta(days=n)
    articles = [(i, i % 3, day(i * 7 % 90)) for i in range(60)] + [(100, 9, day(3))]
    bars = [(t, day(d), 1.0 * d, 2.0, 0.5, 1.0 * t) for t in range(3) for d in range(0, 120, 3) if (d + t) % 4]
    a = spark.createDataFrame(articles, "id long, ticker long, published date")
    b = spark.createDataFrame(bars, "ticker long, date date, open double, high double, low double, close double")
    want = attach_prices(a, b, "published").select("id", "ticker", "published", "prices")
    for k in range(4):  # out of order
        a.where(F.pmod(F.xxhash64("id"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")
        b.where(F.pmod(F.xxhash64("date"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/b")
    end = spark.createDataFrame([(-1, day(1000), 0.0, 0.0, 0.0, 0.0)], b.schema)
    streams = [spark.readStream.schema(x.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/{n}") for n, x in (("a", a), ("b", b))]
    price_timers.run_with_timers(price_timers.attach_by_timers(*streams, delay="500 days", salts=3), f"{tmp_path}/out", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 0  # no window has passed
    end.write.mode("append").parquet(f"{tmp_path}/b")
    got = price_timers.run_with_timers(price_timers.attach_by_timers(*streams, delay="500 days", salts=3), f"{tmp_path}/out", f"{tmp_path}/c")
    assert rows(got) == rows(want)
    for variable in ("waiting", "bars"):
        state = spark.read.format("statestore").option("path", f"{tmp_path}/c").option("stateVarName", variable).load()
        assert state.where("key.ticker >= 0").count() == 0


def test_a_batch_of_articles_and_bars_takes_few_state_calls():
    calls = []

    class State(list):
        def appendList(self, values):
            calls.append("append")
            self.extend(values)

        def put(self, values):
            self[:] = values

        def get(self):
            calls.append("get")
            return iter(list(self))

    class Handle:
        def getListState(self, name, schema):
            return State()

        def registerTimer(self, at):
            calls.append(at)

    class Now:
        def __init__(self, at):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at

    first = date(2024, 1, 1)
    arriving = [Row(id=i, published=first + timedelta(days=i % 50), **dict.fromkeys(price_timers.FIELDS)) for i in range(200)]
    bars = [Row(id=None, published=None, date=first + timedelta(days=i), open=1.0 * i, high=2.0, low=0.5, close=1.0) for i in range(100)]
    windows, key = price_timers.Windows(28), (1, 1520 // 26, 0)
    windows.init(Handle())
    list(windows.handleInputRows(key, iter([*arriving, *bars]), None))
    assert len(calls) <= 4
    soon = price_timers._millis(first + timedelta(days=29))
    assert soon in calls
    out = list(windows.handleExpiredTimer(key, Now(soon), Now(soon)))
    assert sorted(r.id for r in out) == [0, 50, 100, 150] and all(len(r.prices) == 29 for r in out)
    assert len(windows.waiting) == 196 and len(calls) <= 7


def test_articles_and_bars_of_many_tickers_travel_and_wait_as_one(spark, tmp_path):
    first = date(2024, 1, 1)
    day = lambda n: first + timedelta(days=n)
    tickers = [-700, -1, *range(200), 511, 512, None]
    articles = [(i, t, day(i % 4)) for i, t in enumerate(tickers)] + [(900, 5, None), (901, None, None)]
    bars = [(t, day(d), None if d % 2 else float(i), 2.0, None, 1.0 * d) for i, t in enumerate(tickers) for d in (0, 3, 28, 31, 60) if i != 9]
    bars += [(7, None, 1.0, 1.0, 1.0, 1.0)]
    a = spark.createDataFrame(articles, "id long, ticker long, published date")
    b = spark.createDataFrame(bars, "ticker long, date date, open double, high double, low double, close double")
    for x, name in ((a, "a"), (b, "b")):
        x.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema(x.schema).parquet(f"{tmp_path}/{n}") for x, n in ((a, "a"), (b, "b"))]
    priced = price_timers.attach_by_timers(*streams, salts=1)
    got = {r.id: r for r in price_timers.run_with_timers(priced, f"{tmp_path}/out", f"{tmp_path}/c").collect()}
    for variable, most in (("waiting", 0), ("bars", 5)):  # ranges of tickers, not tickers
        state = spark.read.format("statestore").option("path", f"{tmp_path}/c").option("stateVarName", variable).load()
        assert state.count() <= most
    assert len(got) == len(articles)
    for id_, ticker, published in articles:
        own = [tuple(x[1:]) for x in bars if x[0] == ticker and x[1] and published and published <= x[1] <= published + timedelta(days=28)]
        assert got[id_].ticker == ticker and got[id_].published == published
        assert [tuple(p) for p in got[id_].prices or ()] == sorted(own, key=lambda x: x[0]) and got[id_].prices != []


def test_rows_later_than_the_watermark_are_dropped_one_by_one(spark, tmp_path):
    first = date(2024, 1, 1)
    day = lambda n: first + timedelta(days=n)
    schemas = "id long, ticker long, published date", "ticker long, date date, open double, high double, low double, close double"

    def land(articles, bars):
        for rows_, schema, name in zip((articles, bars), schemas, "ab"):
            spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        streams = [spark.readStream.schema(s).parquet(f"{tmp_path}/{n}") for s, n in zip(schemas, "ab")]
        priced = price_timers.attach_by_timers(*streams, delay="10 days", salts=1)
        return price_timers.run_with_timers(priced, f"{tmp_path}/out", f"{tmp_path}/c")

    bar = lambda n, x: (1, day(n), x, x, x, x)
    land([(1, 1, day(0))], [bar(0, 1.0), bar(40, 2.0)])  # the watermark comes to day 30
    land([(2, 1, day(20)), (3, 1, day(35))], [bar(25, 3.0), bar(36, 4.0)])  # the first of each is late
    out = {r.id: [p.open for p in r.prices] for r in land([], [bar(200, 5.0)]).collect()}
    assert out == {1: [1.0], 3: [4.0, 2.0]}
