import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from newslens.catalog import text as catalog
from newslens.ml.transformers import Summarizer
from newslens.operators.beams import coverage_score, search, summarize_beams


def encoded(sents):
    flat = [w for s in sents for w in s]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    return np.array([numbers[w] for w in flat]), np.cumsum([0, *map(len, sents)])


def exhaustive(sents, low, high, penalty):
    flat = [w for s in sents for w in s]
    found = []
    for size in range(1, len(sents) + 1):
        for chosen in itertools.combinations(range(len(sents)), size):
            length = sum(len(sents[i]) for i in chosen)
            covered = {w for i in chosen for w in sents[i]}
            if low <= length <= high and all(len(sents[i]) >= 3 for i in chosen):
                mass = sum(w in covered for w in flat)
                found.append((-float(coverage_score(mass, len(flat), length, penalty)), chosen))
    return list(min(found)[1]) if found else None


def random_text(rng, n):
    return [[rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 9))] for _ in range(n)]


def test_wide_beams_equal_the_exhaustive_search():
    rng, whole = random.Random(3), 0
    for _ in range(300):
        sents = random_text(rng, rng.randint(1, 7))
        penalty = rng.choice([0.0, 1.0, 2.0, -1.0])
        expected = exhaustive(sents, 8, 20, penalty)
        chosen, extra = search(*encoded(sents), 8, 20, 200, penalty)
        if expected is not None:
            whole += 1
            assert (chosen, extra) == (expected, -1)
    assert whole > 150


def test_four_beams_on_short_texts():
    rng, same, n = random.Random(5), 0, 0
    for _ in range(300):
        sents = random_text(rng, rng.randint(1, 6))
        expected = exhaustive(sents, 8, 20, 2.0)
        if expected is not None:
            n += 1
            same += search(*encoded(sents), 8, 20, 4, 2.0)[0] == expected
    assert same >= 0.9 * n


def test_penalty_and_lengths_act(spark):
    text = "One two three four. Alpha beta gamma delta epsilon. One two three four zeta. Red green blue cyan"
    df = spark.createDataFrame([(1, text)], "id long, text string")

    def words(**options):
        return len(summarize_beams(df, **options).first().summary.split())

    assert words(min_length=3, max_length=9, penalty=2.0) > words(min_length=3, max_length=9, penalty=-4.0)
    assert words(min_length=3, max_length=5) <= 5
    assert words(min_length=10, max_length=18, penalty=-4.0) >= 10


def test_odd_texts(spark):
    texts = [None, "", "No.", "one two three four five six seven", "a b c. " * 3, "x" * 100_000]
    rows = [(i, t) for i, t in enumerate([*texts, texts[3]])]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("summary", F.lit(1))
    out = {r.id: r.summary for r in summarize_beams(df, min_length=2, max_length=5).collect()}
    assert out[0] == out[1] == out[2] == out[5] == ""
    assert out[3] == out[6] == "one two three four five"
    assert out[4].startswith("a b c")
    assert summarize_beams(df.limit(0)).count() == 0


def test_given_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = catalog.summarize_beams(spark, sf_dir)
    assert "Exchange" not in found._jdf.queryExecution().toString()
    out = {r.id: r.summary for r in found.collect()}
    assert out.keys() == texts.keys()
    for doc, summary in out.items():
        assert all(part.strip(".") in (texts[doc] or "") for part in summary.split(". "))


def test_the_stage_uses_its_beams(spark):
    text = "Common words here again. Common words here again now. Other things are said too. Yet more is said"
    df = spark.createDataFrame([(text,), (text,)], "input string")
    one = Summarizer(minLength=8, maxLength=10).transform(df).first().output
    four = Summarizer(minLength=8, maxLength=10, numBeams=4, lengthPenalty=2.0).transform(df).first().output
    assert one != four and 8 <= len(four.split()) <= 10
