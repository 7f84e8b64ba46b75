import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer
from pyspark.sql import functions as F

from newslens.operators import matching, vectors
from newslens.operators.vectors import VectorIndex

NAMES = [
    "Tesco plc", "Tesla Inc", "Sanofi SA", "Apple Inc", "Apple Hospitality", "Volkswagen AG",
    "Nvidia Corp", "Novartis AG", "Tesco plc", "Ab", "BP plc", "Barclays plc", "Bayer AG",
]
QUERIES = ["Tesco", "Tesla", "Sanofi", "Apple", "VOLKSWAGEN", "Nvidia Corporation", "zzzz qqqq", "Ab", "", None, "Bayer"]


def grams(name):
    s = name.lower()
    return Counter(s[i : i + 3] for i in range(len(s) - 2))


def brute(names, queries, k, max_distance):
    m = len(names)
    df = Counter(g for n in names for g in grams(n))

    def weigh(name):
        return {g: tf * math.log((m + 1) / (df[g] + 1)) for g, tf in grams(name).items()}

    index = [(i, weigh(n)) for i, n in enumerate(names) if len(n) >= 3]
    out = {}
    for q in queries:
        if not q or len(q) < 3:
            out[q] = []
            continue
        a = weigh(q)
        found = []
        for i, b in index:
            na, nb = (math.sqrt(sum(w * w for w in v.values())) for v in (a, b))
            dot = sum(w * b.get(g, 0.0) for g, w in a.items())
            if dot > 0:
                d = round(1 - round(dot / (na * nb), 6), 6)
                if d < max_distance:
                    found.append((d, i))
        out[q] = [(i, d) for d, i in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("max_distance", [0.3, 0.4, 0.7, 0.95])
@pytest.mark.parametrize("k", [1, 3])
def test_equals_brute_force(spark, k, max_distance):
    symbols = spark.createDataFrame(list(enumerate(NAMES)), "id long, name string")
    queries = spark.createDataFrame([(q,) for q in QUERIES], "name string")
    index = matching.NameIndex.fit(symbols)
    got = matching.nearest_names(queries, index, k, max_distance).collect()
    expected = brute(NAMES, QUERIES, k, max_distance)
    assert len(got) == len(QUERIES)
    for row in got:
        assert [(n.neighbor, n.distance) for n in row.knn] == expected[row.name]


def test_equals_the_ml_feature_stages(spark):
    symbols = spark.createDataFrame(list(enumerate(NAMES)), "id long, name string")
    model = Pipeline(
        stages=[
            RegexTokenizer(inputCol="name", outputCol="tokens", pattern=""),
            NGram(n=3, inputCol="tokens", outputCol="ngrams"),
            HashingTF(inputCol="ngrams", outputCol="tf"),
            IDF(inputCol="tf", outputCol="features"),
        ]
    ).fit(symbols)
    vectors = {r.id: r.features for r in model.transform(symbols).collect()}
    query = spark.createDataFrame([("Tesla Motors Inc",)], "name string")
    q = model.transform(query).first().features
    cosine = {
        i: q.dot(v) / (q.norm(2) * v.norm(2)) for i, v in vectors.items() if v.norm(2) > 0
    }
    best = max(cosine, key=cosine.get)
    index = matching.NameIndex.fit(symbols)
    (row,) = matching.nearest_names(query, index, 1, 0.99).collect()
    assert row.knn[0].neighbor == best
    assert row.knn[0].distance == pytest.approx(1 - cosine[best], abs=2e-6)


def test_unmatched_article_keeps_a_row_with_null_ticker(spark):
    symbols = spark.createDataFrame(
        [(1, "Tesco plc", "TSCO", "LSE"), (2, "Bayer AG", "BAYN", "XETRA")],
        "id long, name string, code string, exchange string",
    )
    companies = spark.createDataFrame([(7, "Tesco plc"), (8, "Unheard of")], "id long, corp string")
    got = {r.id: (r.symbol, r.exchange) for r in matching.match_tickers(companies, symbols).collect()}
    assert got == {7: ("TSCO", "LSE"), 8: (None, None)}


def test_an_index_of_one_name_has_no_direction_and_matches_nothing(spark):
    symbols = spark.createDataFrame([(1, "Tesco plc")], "id long, name string")
    queries = spark.createDataFrame([("Tesco plc",)], "name string")
    (row,) = matching.nearest_names(queries, matching.NameIndex.fit(symbols), 1, 1.0).collect()
    assert row.knn == []


def test_index_is_saved_and_loaded(spark, tmp_path):
    symbols = spark.createDataFrame(list(enumerate(NAMES)), "id long, name string")
    matching.NameIndex.fit(symbols).save(str(tmp_path))
    loaded = matching.NameIndex.load(spark, str(tmp_path))
    queries = spark.createDataFrame([("Tesco",)], "name string")
    (row,) = matching.nearest_names(queries, loaded, 1, 0.95).collect()
    assert row.knn[0].neighbor == 0


def test_common_ngrams_are_never_join_keys(spark):
    """A third of the names share a long ending; only rare n-grams may pair them."""
    names = [f"{i:04d} Global Holdings Group" for i in range(300)] + [f"firm {i}x{i}" for i in range(600)]
    symbols = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    index = matching.NameIndex.fit(symbols)
    keys = index.weighted.where(F.col("rest") >= 0.7 * F.col("norm")).select("gram", "df")
    assert keys.agg(F.max("df")).first()[0] <= 300
    queries = spark.createDataFrame([(n,) for n in names[::7]], "name string")
    got = matching.nearest_names(queries, index, 1, 0.3).collect()
    assert {r.name: r.knn[0].neighbor for r in got} == {n: names.index(n) for n in names[::7]}


def vector_rows(n, dims, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dims))
    if copies:
        rows[:copies] = rows[0]
    return rows


def brute_vectors(index, queries, k):
    def unit(m):
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    distance = np.round(1 - np.round(unit(queries) @ unit(index).T, 6), 6)
    return [[(int(j), d[j]) for j in sorted(range(len(d)), key=lambda j: (d[j], j))[:k]] for d in distance]


@pytest.mark.parametrize("copies", [0, 70])
def test_dense_neighbours_equal_brute_force(spark, copies):
    index, queries = vector_rows(200, 6, 1, copies), vector_rows(60, 6, 2)
    queries[:20] = index[:20]
    schema = "id long, vector array<double>"
    x = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(index)], schema)
    q = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(queries)], schema)
    fitted = VectorIndex.fit(x, k=4, block=16)
    got = {}
    for r in fitted.neighbours(q).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.neighbor, r.distance))
    expected = brute_vectors(index, queries, 4)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {
        i: [j for j, _ in v] for i, v in enumerate(expected)
    }


def test_probed_search_finds_most_and_all_with_all_cells(spark):
    index = vector_rows(300, 8, 5)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(index)], "id long, vector array<double>")
    fitted = VectorIndex.fit(df, k=3)
    expected = {(i, j) for i, v in enumerate(brute_vectors(index, index, 3)) for j, _ in v}

    def found(probes):
        return {(r.id, r.neighbor) for r in fitted.neighbours(df, probes=probes).collect()}

    assert found(len(fitted.pivots)) == expected
    assert len(found(6) & expected) / len(expected) > 0.8


def test_probed_search_finds_nine_in_ten(spark):
    from newslens.catalog import models

    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        exact = {(r.id, r.neighbor) for r in models.knn_dense_exact(spark, sf_dir).collect()}
        probed = {(r.id, r.neighbor) for r in models.knn_dense_probed(spark, sf_dir).collect()}
        print(sf_dir, len(exact & probed) / len(exact))
        assert len(exact & probed) >= 0.9 * len(exact)


@pytest.fixture
def sent(monkeypatch):
    """Rows written as routes; vectors are dealt to several parts and segments."""
    rows = []
    keep = vectors.stored

    def counted(df, purpose):
        out = keep(df, purpose)
        if purpose == "routes":
            rows.append(out.count())
        return out

    monkeypatch.setattr(vectors, "stored", counted)
    monkeypatch.setattr(vectors, "_LEAST", 40)
    monkeypatch.setattr(vectors, "_MOST", 90)
    return rows


def ragged_vectors(spark, n, seed):
    """Ties, copies, parallel, zero and NULL vectors besides random ones."""
    rows = np.concatenate([vector_rows(n, 5, seed), np.random.default_rng(seed).integers(-1, 2, (n, 5)).astype(float)])
    rows[n : n + 5] = 3 * rows[:5]
    data = [(f"k{i:04d}", r.tolist()) for i, r in enumerate(rows)]
    used = [i for i, r in enumerate(rows) if r.any()]
    return rows[used], [data[i][0] for i in used], spark.createDataFrame([*data, ("none", None)], "id string, vector array<double>")


def test_exact_search_sends_a_query_once_not_once_per_cell(spark, sent):
    rows, keys, df = ragged_vectors(spark, 220, 9)
    got = {}
    fitted = VectorIndex.fit(df, k=3, pivots=64)
    for r in fitted.neighbours(df).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.neighbor, r.distance))
    assert sum(sent) <= len(rows)
    for key, expected in zip(keys, brute_vectors(rows, rows, 3), strict=True):
        assert [j for j, _ in got[key]] == [keys[j] for j, _ in expected]
        assert np.allclose([d for _, d in got[key]], [d for _, d in expected], atol=1e-12)
    assert len(got) == len(keys)


def test_probed_search_sends_a_query_once_not_once_per_probe(spark, sent):
    rows, keys, df = ragged_vectors(spark, 220, 11)
    fitted = VectorIndex.fit(df, k=3, pivots=64)
    probes = 20
    got = {}
    for r in fitted.neighbours(df, probes=probes).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbor)
    assert sum(sent) <= len(rows)

    cell_of = {k: r.cell for r in fitted.cells.select("cell", "unit").collect() for k in [tuple(np.round(r.unit, 9) + 0.0)]}
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    cells = np.array([cell_of[tuple(np.round(u, 9) + 0.0)] for u in unit])
    angles = np.arccos(np.clip(unit @ fitted.pivots.T, -1, 1))
    angles[:, fitted.radius < 0] = np.inf
    for i, key in enumerate(keys):
        near = np.sort(angles[i])
        if near[probes] - near[probes - 1] < 1e-9:
            continue  # which of two equally near cells is visited is open
        allowed = np.flatnonzero(angles[i, cells] <= near[probes - 1] + 1e-12)
        expected = brute_vectors(rows[allowed], rows[[i]], 3)[0]
        assert got[key] == [keys[allowed[j]] for j, _ in expected]
