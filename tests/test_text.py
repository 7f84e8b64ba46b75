import random
import re
from datetime import date

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newslens.functions import strings
from newslens.functions import text as tx
from newslens.functions.columns import running_starts
from newslens.operators import companies, entities, gazetteer
from newslens.operators.summaries import summarize_extractive


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "name, loose, strict",
    [
        ("Tesco", True, False),
        ("Economy", True, False),
        ("Volkswagen", True, False),
        ("Sanofi", True, False),
        ("Nvidia", True, False),
        ("asahi", True, False),
        ("Apple", False, False),
        ("Group Think", False, False),
        ("Acme Group", True, True),
        ("Acme plc", True, True),
    ],
)
def test_suffix_rule_as_written_and_strict(spark, name, loose, strict):
    assert one(spark, name, strings.has_corp_suffix) is loose
    assert one(spark, name, lambda c: strings.has_corp_suffix(c, strict=True)) is strict


def test_article_text_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("h", "d", "s"), ("h", None, "s")], "a string, b string, c string")
    out = df.select(strings.article_text(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in out] == ["h. d. s", None]


def test_exchange_aliases(spark):
    got = [one(spark, v, strings.normalize_exchange) for v in ("BATS", "NYSE MKT", "LSE", "")]
    assert got == ["US", "US", "LSE", ""]


def test_url_parts(spark):
    assert one(spark, "https://a.b/stream/x?y=/z#q", strings.url_path) == "/stream/x"
    assert one(spark, "https://a.b", strings.url_path) == ""
    assert one(spark, "https://a.b/c/d.xml", strings.file_name) == "d.xml"
    assert one(spark, "a b+c", strings.url_encode) == "a%20b%2Bc"


def test_ngrams_keep_spaces_and_skip_short_names(spark):
    assert one(spark, "A bc", tx.char_ngrams) == ["a b", " bc"]
    assert one(spark, "ab", tx.char_ngrams) == []
    assert one(spark, "", tx.char_ngrams) == []


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_ratio(a, b):
    if not a or not b:
        return 0
    best = 0.0
    for short, long in ((a, b), (b, a)):
        if len(short) > len(long):
            continue
        n = len(short)
        for i in range(1 - n, len(long)):
            window = long[max(0, i) : i + n]
            best = max(best, 200.0 * lcs(short, window) / (n + len(window)))
    return round(best)


@settings(max_examples=200, deadline=None)
@given(st.text("abcd ", max_size=9), st.text("abcd ", max_size=14))
def test_partial_ratio_is_the_best_window(a, b):
    assert strings.partial_ratio_score(a, b) == brute_ratio(a, b) == strings.partial_ratios([a], [b])[0]


def test_ratios_of_many_pairs_and_long_strings():
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcé 漢") for _ in range(n))
    pairs = [(word(r.randint(0, 200)), word(r.randint(0, 200))) for _ in range(60)] + [(None, "a"), ("a", None), ("ab", "ba"), (word(64), word(64))]
    got = strings.partial_ratios(*map(list, zip(*pairs)))
    assert got.tolist() == [strings.partial_ratio_score(a, b) for a, b in pairs]


def _naive_spans(text, names, lower=str.lower):
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text or "")]
    hits = [
        (a, words[j][1] - 1)
        for i, (a, _) in enumerate(words)
        for j in range(i, min(i + 6, len(words)))
        if " ".join(text[s:e].lower() for s, e in words[i : j + 1]) in names
    ]
    hits.sort(key=lambda h: (h[0], -h[1]))
    return [h for k, h in enumerate(hits) if all(p[1] < h[1] for p in hits[:k])]


def test_name_spans_equal_a_loop():
    r = random.Random(7)
    vocabulary = ["Acme", "acme", "Big", "CO", "é", "İx", "ΟΣ", "σ", "7", "漢字"]
    names = {" ".join(r.choices([w.lower() for w in vocabulary if w != "İx"], k=r.randint(1, 4))) for _ in range(40)}
    texts = ["".join(r.choice(vocabulary) + r.choice([" ", "  ", "-", ", ", "🙂"]) for _ in range(r.randint(0, 30))) for _ in range(200)]
    texts += [None, "", "acme", "..."]
    sorted_names = sorted(names)
    for parts in ([sorted_names], [sorted_names[::2], sorted_names[1::2]]):
        tries = [lambda p=p: gazetteer.Trie(pa.array(p)) for p in parts]
        got = [[(h["start"], h["end"]) for h in row] for row in gazetteer.spans(pa.array(texts), tries).to_pylist()]
        assert got == [_naive_spans(t, names) for t in texts]


def test_entities_need_no_shuffle_and_any_number_of_files(spark):
    texts = spark.createDataFrame([(1, "The Big Co. and acme", None), (2, "", "ACME big co")], "id long, a string, b string")
    names = spark.createDataFrame([("Big Co",), ("Acme",), ("Big",), ("!",), (None,)], "name string")
    grams = entities.normalized_names(names)
    assert len(gazetteer.name_files(grams, file_bytes=12)) > 1
    out = entities.extract_entities(texts, names, {"a": "x", "b": "y"})
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = [[None if e is None else [w.word for w in e] for e in (r.x, r.y)] for r in out.orderBy("id").collect()]
    assert got == [[["Big Co", "acme"], None], [[], ["ACME", "big co"]]]
    nothing = entities.extract_entities(texts, names.limit(0), {"a": "x"}).collect()
    assert [r.x for r in nothing] == [[], []]


def test_partial_ratio_known_values(spark):
    assert strings.partial_ratio_score("Baker Hughes", "Baker Hughes Co") == 100
    assert strings.partial_ratio_score(None, "x") == 0
    df = spark.createDataFrame([("abc", "xxabcxx"), ("abc", None)], "a string, b string")
    assert [r[0] for r in df.select(strings.partial_ratio("a", "b")).collect()] == [100, 0]


def test_partial_levenshtein_of_empty_and_equal(spark):
    df = spark.createDataFrame([("", "x"), (None, "x"), ("abc", "zabcz"), ("zabcz", "abd")], "a string, b string")
    got = [r[0] for r in df.select(strings.partial_levenshtein(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 0.0, 100.0, round(100 - 100 / 3, 6)]


def test_running_starts(spark):
    for n in (0, 1, 7, 8, 9, 64, 1000):
        values = [i % 5 for i in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        got = df.select(running_starts(F.col("v"))).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]


def test_word_runs_locate_words(spark):
    text = "  Ab, cd-ef  Gh! "
    runs = one(spark, text, lambda c: tx.word_runs(c, [1, 2]))
    for run in runs:
        found = text[run.start : run.end + 1]
        assert re.sub(r"[\W_]+", " ", found).lower() == run.gram
    assert [r.gram for r in runs] == ["ab", "cd", "ef", "gh", "ab cd", "cd ef", "ef gh"]
    assert one(spark, "", lambda c: tx.word_runs(c, [1, 2])) == []
    assert one(spark, "...", lambda c: tx.word_runs(c, [1])) == []


NAMES = ["Baker Hughes", "Baker Hughes Energy", "Halliburton", "AT&T", "3M"]


def tag(spark, texts):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = entities.extract_entities(df, names, {"text": "entities"})
    return {r.id: r.entities for r in out.collect()}


def test_longest_name_wins_offsets_are_right_and_null_stays_null(spark):
    texts = ["Shares in Baker Hughes Energy rose; Halliburton and AT&T, 3M fell.", "nothing", None]
    out = tag(spark, texts)
    assert [e.word for e in out[0]] == ["Baker Hughes Energy", "Halliburton", "AT&T", "3M"]
    assert all(texts[0][e.start : e.end + 1] == e.word for e in out[0])
    assert {e.entity_group for e in out[0]} == {"ORG"}
    assert out[1] == [] and out[2] is None


def test_copies_of_one_text_all_get_their_entities(spark):
    out = tag(spark, ["Halliburton rose"] * 300)
    assert len(out) == 300 and all([e.word for e in v] == ["Halliburton"] for v in out.values())


def resolve(spark, rows, **options):
    df = spark.createDataFrame(rows, "id long, topic string, orgs array<string>")
    return {r.id: r for r in companies.resolve_company(df, **options).collect()}


@pytest.mark.parametrize("similarity", [None, companies.best_levenshtein])
def test_resolve_company(spark, similarity):
    out = resolve(
        spark,
        [
            (1, "Baker Hughes", ["Baker Hughes", "zzz"]),
            (2, "Oil", ["Xyz"]),
            (3, "Tesco", []),
            (4, "Tesco", None),
            (5, "Oil", None),
            (6, None, ["a"]),
        ],
        similarity=similarity,
    )
    assert {i: r.corp for i, r in out.items()} == {
        1: "Baker Hughes", 2: "", 3: "Tesco", 4: "Tesco", 5: "", 6: "",
    }
    assert out[3].similarity == 0 and out[4].similarity == 0


def test_each_pair_of_topic_and_name_is_scored_once(spark):
    rows = [(i, "Oil" if i % 3 else "Baker Hughes", ["Baker Hughes", "Xyz", "Xyz"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, topic string, orgs array<string>")
    pairs = df.select("topic", F.explode("orgs").alias("org"))
    scored = companies.pair_ratios(pairs)
    assert scored.count() == 4
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")  # above the aggregate
    assert "hashpartitioning(topic" in plan and "org#" in plan.split("hashpartitioning(topic")[1][:20]
    out = companies.resolve_company(df)
    assert out.count() == 300
    assert {(r.topic, r.corp) for r in out.collect()} == {("Oil", ""), ("Baker Hughes", "Baker Hughes")}


def test_threshold_is_strict(spark):
    assert strings.partial_ratio_score("ab", "ax") == 67
    rows = [(1, "ab", ["ax"])]
    assert resolve(spark, rows, threshold=67)[1].corp == ""
    assert resolve(spark, rows, threshold=66)[1].corp == "ab"


def test_one_null_entity_column_leaves_no_organisations(spark):
    df = spark.createDataFrame(
        [([("ORG", "a"), ("PER", "b")], None), ([("ORG", "a")], [("ORG", "a"), ("ORG", "c")])],
        "x array<struct<entity_group:string,word:string>>, y array<struct<entity_group:string,word:string>>",
    )
    got = [r[0] for r in df.select(entities.organisations(F.col("x"), F.col("y"))).collect()]
    assert got == [None, ["a", "c"]]


def test_summary_is_shorter_whole_sentences_in_order(spark):
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(60)]
    text = ". ".join(" ".join(rng.choices(vocabulary, k=rng.randint(2, 20))) for _ in range(80)) + "."
    df = spark.createDataFrame([(1, text), (2, "Too short."), (3, ""), (4, "one " * 300)], "id long, text string")
    out = {r.id: r.summary for r in summarize_extractive(df, min_length=50, max_length=100).collect()}
    assert 50 <= len(out[1].split()) <= 100 and len(out[1]) < len(text)
    kept = [s for s in re.split(r"\. ", out[1])]
    positions = [text.find(s) for s in kept]
    assert positions == sorted(positions) and -1 not in positions
    assert out[2] == "" and out[3] == ""
    assert len(out[4].split()) == 100


def test_summary_shuffles_the_text_once(spark):
    df = spark.createDataFrame([(1, "a b c. d e f.")], "id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = summarize_extractive(df)
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert text.count("hashpartitioning") == text.count("REPARTITION_BY_COL")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_summary_sorts_no_words_and_equal_keys_share_their_counts(spark):
    texts = [(1, "b c d. a a b! x y z? q"), (1, "b c d. e f g. a a a a"), (None, "a b c. d e f."), (2, None), (3, "..  !  "), (4, "ΣΟΦΟΣ. οφος Σ! a_b c-d")]
    df = spark.createDataFrame(texts, "id long, text string")
    out = summarize_extractive(df, min_length=4, max_length=8)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = sorted((r.id is None, r.id or 0, r.summary) for r in out.collect())
    assert found == [
        (False, 1, "a a b. x y z"), (False, 1, "e f g. a a a a"), (False, 2, ""), (False, 3, ""), (False, 4, "a_b c-d"), (True, 0, ""),
    ]
