import math
import re
from collections import Counter

from newslens.operators.sentence_ends import abbreviations, count_periods, split_sentences

TEXT = (
    "Mr. Bell met Dr. Ash at noon. They spoke of the market. The market rose! Did Mr. Bell sell? "
    "Shares of the U.S. maker rose. Dr. Ash bought them. The price was 3.14 at noon. They met again"
)


def expected_scores(texts, threshold=0.3):
    n, dotted = Counter(), Counter()
    for text in texts:
        for t in re.findall(r"[^\W_]+(?:\.[^\W_]+)*\.?", (text or "").lower()):
            n[t.rstrip(".")] += 1
            dotted[t.rstrip(".")] += t.endswith(".")
    p = sum(dotted.values()) / sum(n.values())
    out = {}
    for word, total in n.items():
        k, rest, letters = dotted[word], total - dotted[word], len(word.replace(".", ""))
        if k and re.search(r"[^\W\d_]", word):
            ratio = 2 * (k * math.log(0.99 / p) + rest * math.log(0.01 / (1 - p)))
            score = ratio * math.exp(-letters) * (word.count(".") + 1) / letters**rest
            if score >= threshold:
                out[word] = (total, k, round(score, 6))
    return out


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_scores_equal_a_loop_and_abbreviations_are_found(spark):
    texts = [TEXT] * 20 + [None, "", "no period", "A. B. C."] + ["by noon all of them rose in the market"] * 9
    found = {r.word: (r.n, r.n_period, r.score) for r in abbreviations(count_periods(table(spark, texts))).collect()}
    expected = expected_scores(texts)
    assert found.keys() == expected.keys() and {"mr", "dr", "u.s"} <= found.keys()
    assert not {"noon", "market", "rose", "them"} & found.keys()
    assert all(abs(found[w][2] - s[2]) < 1e-5 and found[w][:2] == s[:2] for w, s in expected.items())


def test_sentences_end_where_no_abbreviation_is(spark):
    df = table(spark, [TEXT, None, "", "  \n ", "Ask Mr.", "One.  Two?\n\nThree!", TEXT])
    known = spark.createDataFrame([("mr",), ("dr",), ("u.s",)], "word string")
    rows = split_sentences(df, known).orderBy("id", "pos").collect()
    by_id = {i: [r.sentence for r in rows if r.id == i] for i in range(7)}
    assert by_id[0] == by_id[6] == [
        "Mr. Bell met Dr. Ash at noon.",
        "They spoke of the market.",
        "The market rose!",
        "Did Mr. Bell sell?",
        "Shares of the U.S. maker rose.",
        "Dr. Ash bought them.",
        "The price was 3.14 at noon.",
        "They met again",
    ]
    assert by_id[1] == by_id[2] == by_id[3] == []
    assert by_id[4] == ["Ask Mr."] and by_id[5] == ["One.", "Two?", "Three!"]
    assert [r.pos for r in rows if r.id == 0] == list(range(8))


def test_nothing_known_and_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, text string")
    counts = count_periods(empty)
    assert abbreviations(counts).count() == 0
    assert split_sentences(empty, abbreviations(counts)).count() == 0
    assert abbreviations(count_periods(table(spark, ["no period here"]))).count() == 0
    long = " ".join(["Mr. Long went on."] * 20_000)
    known = spark.createDataFrame([("mr",)], "word string")
    assert split_sentences(table(spark, [long]), known).count() == 20_000
