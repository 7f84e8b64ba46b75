import hashlib
from datetime import datetime, timedelta

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.ml import direction
from newslens.ml.transformers import NamedEntityRecognizer, Summarizer, Vectorizer
from newslens.operators import evaluation, merge
from newslens.settings import shared_dir
from newslens.streaming import incremental, price_join

ARTICLE = (
    "Baker Hughes said on Wednesday that quarterly revenue had fallen. Shares in Baker Hughes dropped. "
    "The oilfield services company blamed supply chains for weak sales. Halliburton, a rival, did better. "
    "Analysts expected more of the company. The outlook for the company and for oil is uncertain this year. "
) * 8


def text_df(spark):
    return spark.createDataFrame([(1, ARTICLE), (2, None), (3, ARTICLE)], "id long, input string")


def test_entities_found(spark, tmp_path):
    names = spark.createDataFrame([("Baker Hughes",), ("Halliburton",)], "name string")
    names.write.parquet(f"{tmp_path}/entity_names")
    stage = NamedEntityRecognizer(cleanAnnotations=False, emrfsModelPath=str(tmp_path))
    out = PipelineModel(stages=[stage]).transform(text_df(spark))
    rows = {r.id: r for r in out.collect()}
    assert any(e.word == "Baker Hughes" and e.entity_group == "ORG" for e in rows[1].output)
    assert rows[1].output == rows[3].output and rows[2].output is None
    assert {"sentence", "token"} <= set(out.columns)
    assert "sentence" not in stage.setCleanAnnotations(True).transform(text_df(spark)).columns


def test_texts_summarized(spark):
    stage = Summarizer(minLength=30, maxLength=60, lengthPenalty=2.0, numBeams=4)
    rows = {r.id: r.output for r in stage.transform(text_df(spark)).collect()}
    assert 0 < len(rows[1].split()) <= 60 and len(rows[1]) < len(ARTICLE)
    assert rows[1] == rows[3] and rows[2] is None


def test_texts_vectorized(spark):
    out = Vectorizer(outputCol="embeddings").transform(text_df(spark))
    assert T.StructField("embeddings", T.ArrayType(VectorUDT(), True), True).dataType == out.schema["embeddings"].dataType
    rows = {r.id: r.embeddings for r in out.collect()}
    assert len(rows[1]) == 1 and abs(rows[1][0].norm(2) - 1) < 1e-9 and rows[2] is None
    assert "token" not in out.columns


def test_words_are_counted_by_md5_bucket(spark):
    df = spark.createDataFrame([("b a, B b",), ("",)], "input string")
    out = [r.v[0].toArray() for r in Vectorizer(inputCol="input", outputCol="v", numFeatures=64).transform(df).collect()]
    expected = [0.0] * 64
    for word in ("a", "b", "b", "b"):
        expected[int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % 64] += 1 / 10**0.5
    assert max(abs(x - y) for x, y in zip(out[0], expected)) < 1e-12
    assert not out[1].any()


def test_trees_learn_a_rule_on_the_given_vectors(spark):
    # The table's own labels can't be told from its vectors (0.49 right, 0.52 are of one label).
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("embedding is not null").select(
        F.col("vec_id").alias("id"),
        F.array(array_to_vector("embedding")).alias("embeddings"),
        F.when(F.get("embedding", F.lit(0)) > 0, "rise").otherwise("fall").alias("label"),
    )
    trained = direction.train(vectors, by_id="id", rounds=5, seed=1)
    counts = [r["count"] for r in trained.scored.groupBy("label").count().collect()]
    assert trained.accuracy() > 0.9 > max(counts) / sum(counts)


def test_stages_are_saved_with_their_params(spark, tmp_path):
    stages = [
        Summarizer(inputCol="input", outputCol="s", minLength=5, maxLength=9),
        Vectorizer(inputCol="s", outputCol="v", numFeatures=32),
    ]
    path = str(tmp_path / "m")
    Pipeline(stages=stages).fit(text_df(spark)).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[0].getMaxLength() == 9 and loaded.stages[1].getNumFeatures() == 32
    assert loaded.stages[0].getNumBeams() == 1
    assert loaded.transform(text_df(spark)).count() == 3


def test_a_model_gets_batches_and_parameters(spark):
    def load():
        return lambda batch: pd.Series(
            [f"{t}|{n}|{b}" for t, n, b in zip(batch["input"], batch["max_length"], batch["num_beams"])]
        )

    df = spark.createDataFrame([("x",), ("y",)], "input string")
    out = Summarizer(maxLength=7, numBeams=4).setModel(load).transform(df)
    assert sorted(r.output for r in out.collect()) == ["x|7|4", "y|7|4"]


def labelled(spark, n=300):
    rows = [(i, "rise" if i % 3 else "fall", "good profit up" if i % 3 else "bad loss down") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label string, text string")
    return Vectorizer(inputCol="text", outputCol="embeddings", numFeatures=32).transform(df)


def test_training_scoring_and_reload(spark, tmp_path):
    trained = direction.train(labelled(spark), by_id="id", rounds=2, seed=1)
    assert trained.accuracy() == 1.0
    assert trained.model.stages[1].labels == ["rise", "fall"]
    trained.save(str(tmp_path / "gbt"))
    news = spark.createDataFrame(
        [(1, "good profit up", "good", "up"), (2, "bad loss down", "bad", "down"), (3, "h", None, "s")],
        "id long, headline string, description string, summary string",
    )
    out = direction.predict_direction(news, str(tmp_path / "gbt"), Vectorizer(numFeatures=32))
    assert {r.id: r.prediction for r in out.collect()} == {1: "rise", 2: "fall"}


def test_two_embeddings_give_two_predictions(spark):
    trained = direction.train(labelled(spark), by_id="id", rounds=1, seed=1)
    twice = labelled(spark, 3).withColumn("embeddings", F.concat("embeddings", "embeddings")).drop("label")
    assert trained.model.transform(twice).count() == 6


def test_row_split_is_seeded_and_id_split_keeps_articles_whole(spark):
    doubled = labelled(spark).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    training, held_out = direction.split(doubled, "id", 0.7, None)
    assert not {r.id for r in training.collect()} & {r.id for r in held_out.collect()}
    share = training.count() / doubled.count()
    assert 0.6 < share < 0.8
    a, b = (direction.split(doubled, None, 0.7, 5)[0].count() for _ in range(2))
    assert a == b


def test_label_index_and_accuracy(spark):
    df = spark.createDataFrame([("b", "b"), ("a", "b"), ("b", "b"), ("a", "a"), ("c", "c")], "label string, prediction string")
    index = {r.label: r["index"] for r in evaluation.label_index(df).collect()}
    assert index == {"a": 0.0, "b": 1.0, "c": 2.0}
    row = evaluation.accuracy(df).first()
    assert (row.accuracy, row.rows) == (0.8, 5)


def test_streamed_updates_equal_one_batch_upsert_also_after_a_restart(spark):
    folder = shared_dir(spark, "test")
    schema = "id long, v string, seq long"
    base = spark.createDataFrame([(i, "base") for i in range(10)], "id long, v string")

    def land(n):
        rows = [(i % 12, f"v{n}", n * 100 + i) for i in range(n, n + 9)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        updates = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        incremental.log_updates(updates, ["id"], ["seq"], f"{folder}/log", f"{folder}/check")
        out = incremental.current(spark, base, f"{folder}/log", ["id"], ["seq"])
        return sorted(map(tuple, out.collect()))

    def batch():
        updates = spark.read.schema(schema).parquet(f"{folder}/in")
        return sorted(map(tuple, merge.upsert(base, updates, ["id"], ["seq"]).collect()))

    for n in range(5):
        land(n)
    assert run() == batch()
    assert run() == batch()
    land(7)
    assert run() == batch()


def test_a_folded_log_and_a_fresh_checkpoint_lose_nothing(spark):
    folder = shared_dir(spark, "test")
    schema = "id long, v string, seq long"
    base = spark.createDataFrame([(0, "base"), (9, "base")], "id long, v string")

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run(log, checkpoint):
        updates = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        incremental.log_updates(updates, ["id"], ["seq"], f"{folder}/{log}", f"{folder}/{checkpoint}")
        out = incremental.current(spark, base, f"{folder}/{log}", ["id"], ["seq"])
        return sorted(map(tuple, out.collect()))

    land([(0, "a", 5), (1, "a", 6)])
    land([(1, "b", 8), (2, "b", 7)])
    expected = [(0, "a"), (1, "b"), (2, "b"), (9, "base")]
    assert run("log", "check") == expected
    incremental.compact(spark, f"{folder}/log", ["id"], ["seq"], f"{folder}/log2")
    assert incremental.read_log(spark, f"{folder}/log2").count() == 3
    land([(1, "late", 1), (3, "c", 9)])
    expected = sorted([*expected, (3, "c")])
    assert run("log2", "check") == expected
    # A fresh checkpoint reads the input again; what the old one logged stays.
    before = incremental.read_log(spark, f"{folder}/log2").count()
    assert run("log2", "check2") == expected
    assert incremental.read_log(spark, f"{folder}/log2").count() > before


def test_daily_prices_of_trades_that_come_out_of_order(spark):
    folder, start = shared_dir(spark, "test"), datetime(2024, 1, 1)
    trades = [("T", start + timedelta(days=d % 9, hours=d % 5), float(d * 7 % 31), d) for d in range(90)]
    schema = "ticker string, traded timestamp, price double, seq long"
    for part in (trades[60:], trades[:30], trades[30:60]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    price_join.log_daily_bars(arriving, f"{folder}/log", f"{folder}/check")
    bars = price_join.logged_bars(spark, f"{folder}/log")
    articles = spark.createDataFrame(
        [(1, "T", start.date()), (2, "T", (start + timedelta(days=5)).date()), (3, "U", start.date())],
        "id long, ticker string, published date",
    )
    got = price_join.attach_logged_prices(articles, bars, days=2).collect()
    assert sorted(r.id for r in got) == [1, 1, 1, 2, 2, 2, 3]
    assert [r.open for r in got if r.id == 3] == [None]
    for r in got:
        if r.id != 3:
            day = [t for t in trades if t[1].date() == r.date]
            prices = [t[2] for t in day]
            assert (r.open, r.high, r.low, r.close) == (prices[0], max(prices), min(prices), prices[-1])


def test_streamed_price_join_equals_batch_over_several_files(spark):
    folder, start = shared_dir(spark, "test"), datetime(2024, 1, 1)
    articles = [(i, "H" if i % 3 else "T", start + timedelta(hours=7 * i)) for i in range(60)]
    trades = [("H" if i % 2 else "T", start + timedelta(hours=5 * i), float(i)) for i in range(200)]
    a = spark.createDataFrame(articles, "id long, ticker string, published timestamp")
    t = spark.createDataFrame(trades, "ticker string, traded timestamp, price double")
    for df, name, order in ((a, "a", "published"), (t, "t", "traded")):
        df.repartitionByRange(3, order).write.parquet(f"{folder}/{name}")
    streams = [spark.readStream.schema(df.schema).parquet(f"{folder}/{n}") for df, n in ((a, "a"), (t, "t"))]
    joined = price_join.join_trades(*streams, days=7)
    got = price_join.run_to_table(joined, f"{folder}/out", f"{folder}/check")
    expected = sorted(
        (i, k, p, d, x) for i, k, p in articles for j, d, x in trades if j == k and p <= d <= p + timedelta(days=7)
    )
    assert sorted(map(tuple, got.collect())) == expected


def test_streamed_trades_of_one_ticker_are_spread_over_its_pages(spark):
    folder, start = shared_dir(spark, "test"), datetime(2024, 1, 1)
    a = spark.createDataFrame([(i, "H", start + timedelta(days=i)) for i in range(60)], "id long, ticker string, published timestamp")
    t = spark.createDataFrame([("H", start + timedelta(hours=12 * i), float(i)) for i in range(150)], "ticker string, traded timestamp, price double")
    for df, name in ((a, "a"), (t, "t")):
        df.write.parquet(f"{folder}/{name}")
    streams = [spark.readStream.schema(df.schema).parquet(f"{folder}/{n}") for df, n in ((a, "a"), (t, "t"))]
    joined = price_join.join_trades(*streams, days=2).withColumn("part", F.spark_partition_id())
    got = price_join.run_to_table(joined, f"{folder}/out", f"{folder}/check")
    assert got.select("part").distinct().count() > 4
    assert got.count() == got.select("id", "traded").distinct().count() == 60 * 5


def test_a_log_without_updates_leaves_the_base_as_it_is(spark):
    folder = shared_dir(spark, "test")
    schema = "id long, v string, seq long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/in")
    updates = spark.readStream.schema(schema).parquet(f"{folder}/in")
    incremental.log_updates(updates, ["id"], ["seq"], f"{folder}/log", f"{folder}/check")
    base = spark.createDataFrame([(1, "a")], "id long, v string")
    out = incremental.current(spark, base, f"{folder}/log", ["id"], ["seq"])
    assert [tuple(r) for r in out.collect()] == [(1, "a")]


def test_a_table_streams_as_one_file_and_as_a_folder(spark, sf_dir, tmp_path):
    from newslens.catalog.streams import stream

    spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    counts = []
    for n, folder in enumerate((sf_dir, str(tmp_path))):
        query = (
            stream(spark, folder, "orders").writeStream.format("memory").queryName(f"orders{n}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        counts.append(spark.table(f"orders{n}").count())
    assert counts == [1500, 1500]
