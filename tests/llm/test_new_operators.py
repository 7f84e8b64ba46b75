"""Periodic runs, lexical search and language-model scores against brute force; odd inputs."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslens.llm import hash_arrays, html_extract, lexical, lm_score, periodic, piece_codec, textcore

ODD = [
    (1, None), (2, ""), (None, "the cat sat on the mat the cat sat on the mat the cat sat"), (3, "a a a a a a a a a a a a a a a"),
    (3, "a a a a a a a a a a a a a a a"), (4, "word " * 60_000), (5, " \t\n\x0b 12 34 !! 🙂\x00x \r\n"), (6, "Éa éa A a  b"),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns of names that operators add."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    names = "row runs collapsed n_words score rank query key level base_score n_tokens train_tokens item_id".split()
    return docs.withColumns({c: F.lit(7) for c in names})


def _words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# --- 11 ------------------------------------------------------------------------


def _runs(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(2 * p, least):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(20))
def test_runs_equal_a_loop(seed):
    r = random.Random(seed)
    texts = []
    for _ in range(40):
        words = [f"w{r.randint(0, r.choice([1, 2, 3, 20]))}" for _ in range(r.randint(0, 150))]
        if len(words) > 3 and r.random() < 0.5:
            a = r.randrange(len(words))
            p = 1 + (len(words) - a) // r.randint(2, 6)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        texts.append(words)
    n, found, collapsed = periodic._slice([" ".join(w).encode() for w in texts], 12)
    for words, count, got, text in zip(texts, n, found, collapsed, strict=True):
        want = _runs(words)
        assert count == len(words) and [(g["start"], g["length"], g["period"]) for g in got] == want
        assert text.decode() == _collapsed(words, want)


def test_extensions_equal_a_loop(monkeypatch):
    r = np.random.default_rng(2)
    words = np.concatenate([np.tile(r.integers(0, 9, 47), 9), r.integers(0, 2, 300), np.zeros(200, int)]).astype(np.int32)
    x, y = r.integers(0, len(words), (2, 4000))
    x, y = x[x != y], y[x != y]
    naive = [next((k for k in range(len(words)) if max(a, b) + k >= len(words) or words[a + k] != words[b + k])) for a, b in zip(x, y)]
    assert periodic.Extensions(words)(x, y).tolist() == naive
    monkeypatch.setattr(periodic, "CHUNK", 50)
    starts, ends, periods = periodic.runs(words, len(words))
    assert list(zip(starts, ends - starts, periods)) == _runs(words.tolist())


def test_runs_query_equals_brute_force(spark, sf_dir, odd):
    got = {r.doc_id: r for r in periodic.op11(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        words, h = _words(d.text), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, r = _runs(words), got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, (r.start, r.length, r.period, r.exponent_milli)) == (len(runs), want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_collapsed(words, runs).encode()).hexdigest()
    assert any(r.n_runs for r in got.values())
    out = periodic.find_runs(odd)
    assert set(odd.columns) <= set(out.columns) and periodic.find_runs(odd.limit(0)).count() == 0
    for r in out.collect():
        want = _runs(_words(r.text)) if len(r.text or "") < 1000 else [(0, 60_000, 1)]
        assert [tuple(x) for x in r.runs] == want and r.collapsed == _collapsed(_words(r.text), want)


# --- 12 ------------------------------------------------------------------------


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def _ranked(docs, queries, k):
    tfs = [(i, Counter(_terms(t))) for i, t in docs]
    lengths = [sum(tf.values()) for _, tf in tfs]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, tf in tfs for t in tf)
    out = {}
    for q, text in queries:
        scored = []
        for (i, tf), length in zip(tfs, lengths, strict=True):
            m = 75 + (25 * length * n) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in _terms(text) if tf[t])
            if s > 0:
                scored.append((-s, i is not None, i or 0))
        out[q] = [(i if known else None, -s) for s, known, i in sorted(scored)[:k]]
    return {q: v for q, v in out.items() if v}


def test_search_equals_brute_force_in_any_shards(spark):
    r = random.Random(4)
    vocabulary = [f"t{int(r.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 80)))) for i in range(900)] + [(7, "t1 t2 t1"), (None, "T1 t2"), (None, None), (9, "")]
    queries = [(f"q{i}", " ".join(r.choices(vocabulary, k=r.randint(0, 12)))) for i in range(30)] + [(None, "t1 t1"), ("none", None), ("!", "?!")]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "rank", "score", "path")})
    b = spark.createDataFrame([*queries, queries[0]], "item_id string, text string").withColumn("score", F.lit("x"))
    want = _ranked(docs, queries, 20)
    for shard, group in ((1 << 25, 512), (300, 7)):
        got = defaultdict(list)
        for x in lexical.search(a, b, shard_bytes=shard, group_queries=group).orderBy("rank").collect():
            got[x.item_id].append((x.rank, x.doc_id, x.score))
        assert {q: [(d, s) for _, d, s in v] for q, v in got.items()} == want
        assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in got.values())
    assert lexical.search(a.limit(0), b).count() == 0 and lexical.search(a, b.limit(0)).count() == 0


def test_blocks_are_skipped_and_read_right():
    r = np.random.default_rng(1)
    docs = np.flatnonzero(r.random(5000) < 0.4)
    tfs = np.where(r.random(len(docs)) < 0.01, r.integers(1, 70_000, len(docs)), 1)
    lengths = np.full(5000, 70_000)
    shard = lexical.Shard(lexical.build(list(range(5000)), lengths, np.full(len(docs), 5, np.uint64), docs, tfs), 5000, 5000 * 70_000)
    at, gained = shard.read(np.arange(len(shard.size)))
    assert at.tolist() == docs.tolist() and gained.tolist() == lexical.impact(tfs, shard.m[docs]).tolist()
    some = np.array([3, 7, 8])
    at, _ = shard.read(some)
    assert at.tolist() == np.concatenate([docs[128 * k : 128 * (k + 1)] for k in some]).tolist()
    # a rare and a frequent list: blocks without candidates stay compressed
    rare = np.arange(0, 40)
    terms = np.concatenate([np.full(len(docs), 5, np.uint64), np.full(40, 6, np.uint64)])
    order = np.argsort(np.concatenate([docs, rare]), kind="stable")
    shard = lexical.Shard(lexical.build(list(range(5000)), lengths, terms[order], np.concatenate([docs, rare])[order], np.ones(len(order), int)), 5000, 5000 * 70_000)
    read, plain = [], shard.read
    shard.read = lambda blocks: read.append(len(blocks)) or plain(blocks)
    shard.search(np.array([5, 6], np.uint64), np.array([10, 9000]), 20)
    assert sum(read) <= 2 < len(shard.size)


# --- 13 ------------------------------------------------------------------------


def _kneser_ney(train, order):
    """Probability of a word after a context by dictionaries of tuples."""
    grams = [Counter() for _ in range(order + 1)]
    words = Counter()
    for text in train:
        row = ["<s>"] * (order - 1) + text
        words.update(text)
        for i in range(order - 1, len(row)):
            for n in range(1, order + 1):
                grams[n][tuple(row[i - n + 1 : i + 1])] += 1
    counts = [None, *[Counter() for _ in range(order)]]
    counts[order] = grams[order]
    for n in range(1, order):
        for g in grams[n + 1]:
            counts[n][g[1:]] += 1
    by, contexts = [None], [None]
    for n in range(1, order + 1):
        ns = [sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)]
        by.append((0, *lm_score.discounts_of(ns)))
        own = defaultdict(lambda: [0, 0, 0, 0])
        for g, c in counts[n].items():
            own[g[:-1]][0] += c
            own[g[:-1]][min(c, 3)] += 1
        contexts.append(own)

    def p(context, word, n):
        if n == 0:
            return 1 / (len(words) + 1)
        context = tuple(context[len(context) - n + 1 :])
        lower = p(context[1:], word, n - 1)
        if context not in contexts[n]:
            return lower
        total, *kinds = contexts[n][context]
        c = counts[n][context + (word,)]
        return max(c - by[n][min(c, 3)], 0) / total + sum(d * k for d, k in zip(by[n][1:], kinds)) / total * lower

    return p, words


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_dictionaries(spark, sf_dir, order):
    lower = lambda t: (t or "").translate({i: i + 32 for i in range(65, 91)})
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()][:150] + ODD[:4] + ODD[6:]
    texts = [[*_words(lower(t)), "</s>"] for _, t in docs]
    half = len(docs) // 2
    p, words = _kneser_ney(texts[:half], order)
    model = lm_score.train(spark.createDataFrame(docs[:half], "doc_id long, text string"), order=order)
    total, distinct = sum(words.values()), len(words)
    assert (model.tokens, model.words) == (total, distinct)
    got = lm_score.score(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "k long, text string"), model).orderBy("k").collect()
    for row, text in zip(got, texts, strict=True):
        padded = ["<s>"] * (order - 1) + text
        want = sum(math.log10(p(tuple(padded[i - order + 1 : i]), padded[i], order)) for i in range(order - 1, len(padded)))
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in text)
        assert (row.n_tokens, row.n_known) == (len(text), sum(words[w] > 0 for w in text))
        assert math.isclose(row.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(row.score, want, rel_tol=1e-9, abs_tol=1e-9)


def test_lm_on_odd_rows_and_held_out_rows(spark, sf_dir, odd):
    out = lm_score.score(odd, lm_score.train(odd))
    assert set(odd.columns) <= set(out.columns) and out.count() == len(ODD)
    assert lm_score.perplexity(out).where("perplexity < 1").count() == 0
    nothing = lm_score.score(odd, lm_score.train(odd.limit(0))).collect()
    assert all(r.score == r.n_known == r.train_tokens == 0 for r in nothing)
    assert lm_score.score(odd.limit(0), lm_score.train(odd)).count() == 0
    rows = lm_score.op13(spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert rows[2] and rows[0] > rows[1]


def test_arrays_are_found_as_written(tmp_path):
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64))
    n = np.arange(5000) % 700
    for b in range(4):
        own = (keys >> np.uint64(62)) == b
        hash_arrays.save(f"file://{tmp_path}", f"t-{b}", {"key": keys[own]} | hash_arrays.narrow("n", n[own]))
    ask = np.concatenate([keys[::3], keys[::7] + np.uint64(1)])
    want = dict(zip(keys.tolist(), n.tolist()))
    assert hash_arrays.lookup(f"file://{tmp_path}", "t", 2, ask, ["n"])[0].tolist() == [want.get(k, 0) for k in ask.tolist()]
    assert textcore.mix(ask).dtype == np.uint64


# --- 4 -------------------------------------------------------------------------


@pytest.mark.parametrize("page, want", [
    ('<article class="post has-sidebar"><p>The body of this page</p></article>', "The body of this page"),
    ('<div class="page has-sidebar"><article><p>a</p></article></div>', "a"),
    ('<div class="widget"><article><p>a</p><div class="ad">x</div></article></div>', "a"),
    ('<article>a</article><div class="related"><article>b</article></div>', "a"),
    ('<main><div class="sidebar-left"><article>a</article></div></main>', "a"),
    ('<main>m<div class="share-buttons"><article>b</article></div></main>', "m"),
    ('<article><div class="comment-list"><p>c</p></div>a<ul><li>1<li>2</ul></article>', "a\n\n1\n\n2"),
    ('<aside><article>x</article></aside><article>a</article>', "a"),
    ('<article>a <b>b</i> c</b></article>', "a b c"),
])
def test_articles_keep_their_text(page, want):
    assert "\n\n".join(t for k, t in html_extract.blocks(page) if k == html_extract.BODY) == want


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "</i>" * 40_000, "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000, "<p><i>" * 30_000])
def test_long_pages_take_linear_time(page):
    start = time.perf_counter()
    html_extract.blocks(page + "end")
    assert time.perf_counter() - start < 3


def test_a_large_batch_of_texts_is_encoded_and_sent_in_small_ones():
    texts = [f"word{i} " * 4000 for i in range(200)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["row", "text"])
    model = piece_codec.pieces(piece_codec.default_model())
    out = list(piece_codec.worked([batch], model, ["row"], ["row", "ids"], piece_codec._ids))
    sizes = [sum(len(texts[i] or "") for i in b.column("row").to_pylist()) for b in out]
    assert max(sizes) <= piece_codec.SLICE_BYTES and len(out) > 5
    assert [i for b in out for i in b.column("row").to_pylist()] == list(range(len(texts)))
    ids = [i for b in out for i in b.column("ids").to_pylist()]
    assert ids[-2:] == [None, []] and len(set(map(len, ids[:10]))) == 1


def test_a_lookup_takes_little_more_than_its_keys_and_values(tmp_path):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 64, 400_000, np.uint64))
    values = rng.integers(0, 600, len(keys))
    for number in range(16):
        own = (keys >> np.uint64(60)) == number
        hash_arrays.save(str(tmp_path), f"t-{number}", {"key": keys[own]} | hash_arrays.narrow("n", values[own]))
    order = rng.permutation(len(keys))
    asked = np.append(keys[order], keys[:1] + np.uint64(1))
    tracemalloc.start()
    (got,) = hash_arrays.lookup(str(tmp_path), "t", 4, asked, ["n"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == [*values[order].tolist(), 0]
    assert peak < 4.5 * asked.nbytes


def test_words_are_numbered_with_the_start_mark():
    data = np.frombuffer(b"a b aa", np.uint8)
    token, bounds = lm_score.tokens(data, np.array([0, 4, 4, 6]))
    own, word, before = lm_score.word_numbers(token, bounds)
    assert own[word].tolist() == token.tolist()
    assert own[before].tolist() == lm_score.grams(token, bounds, 2)[1][0].tolist()
