"""The trained tagger: search against all tag sequences, names that were never seen, mixing, odd texts."""

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newslens.ml import tagger
from newslens.operators.entities import extract_entities


def test_decoding_equals_trying_all_tags():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = rng.integers(1, 6, 4)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        emission, move = rng.normal(size=(bounds[-1], 3)), rng.normal(size=(4, 3))
        found = tagger.decode(emission, move, bounds)
        for a, b in zip(bounds[:-1], bounds[1:]):
            best = None
            for tags in itertools.product(range(3), repeat=int(b - a)):
                before = (tagger.START, *tags[:-1])
                if any(t == tagger.INSIDE and p in (tagger.OUTSIDE, tagger.START) for p, t in zip(before, tags)):
                    continue
                score = sum(move[p, t] + emission[a + k, t] for k, (p, t) in enumerate(zip(before, tags)))
                best = max(best or (score, tags), (score, tags))
            assert tuple(found[a:b]) == best[1]


def _sentences(rng: random.Random, names: list[str], n: int) -> list[str]:
    forms = [
        "Shares of {} rose on Monday.", "Yesterday {} said its profit fell.", "The chief of {} will leave in May!",
        "Nothing was said about London or Paris.", "Prices fell, but analysts at {} were calm.", "On Friday the weather was fine.",
    ]
    return [" ".join(rng.choice(forms).format(rng.choice(names)) for _ in range(3)) for _ in range(n)]


def _names(rng: random.Random, n: int) -> list[str]:
    sound = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)).capitalize()
    return [f"{sound()} {rng.choice(['Group', 'Inc', 'Holdings', 'plc'])}" for _ in range(n)]


def test_names_that_were_never_seen_are_found(spark):
    rng = random.Random(3)
    seen, unseen = _names(rng, 60), _names(rng, 60)
    as_table = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    texts = lambda names, n: spark.createDataFrame([(t,) for t in _sentences(rng, names, n)], "text string")
    labelled = extract_entities(texts(seen, 300).repartition(4), as_table(seen), {"text": "spans"})
    weights = tagger.train(labelled, "text", "spans", bits=14)
    assert weights.shape == (2**14 + 4, 3)
    held = extract_entities(texts(unseen, 100), as_table(unseen), {"text": "gold"})
    out = held.withColumn("found", tagger.organisations(held, weights, "text")).collect()
    gold = {(i, e.start, e.end) for i, r in enumerate(out) for e in r.gold}
    found = {(i, e.start, e.end) for i, r in enumerate(out) for e in r.found}
    assert len(gold) > 100 and 2 * len(gold & found) / (len(gold) + len(found)) > 0.9


def test_odd_texts_and_nothing_to_learn(spark):
    none = spark.createDataFrame([], "text string, spans array<struct<start:int,end:int>>")
    weights = tagger.train(none, "text", "spans", rounds=1, bits=8)
    assert not weights.any()
    texts = pa.array([None, "", "   ", "one", "Ünïcode 漢字 🙂 Inc.", "a " * 5000])
    assert tagger.tagged_spans(texts, weights).to_pylist() == [[]] * 6
    df = spark.createDataFrame([(None, None), ("Abc Inc rose", None), ("", [])], none.schema)
    assert not tagger.train(df, "text", "spans", rounds=1, bits=8).any()
    assert df.select(F.size(tagger.organisations(df, weights, "text")).alias("n")).agg(F.sum("n")).first()[0] == 0


def test_decoding_gathers_words_once_not_at_every_place():
    class Counted(np.ndarray):
        taken = 0

        def __getitem__(self, at):
            Counted.taken += isinstance(at, np.ndarray)
            return super().__getitem__(at)

    rng = np.random.default_rng(6)
    bounds = np.array([0, 0, 40, 41, 41, 300])
    emission, move = rng.normal(size=(300, 3)), rng.normal(size=(4, 3))
    found = tagger.decode(emission.view(Counted), move, bounds)
    assert Counted.taken == 1
    alone = [tagger.decode(emission[a:b], move, np.array([0, b - a])) for a, b in zip(bounds[:-1], bounds[1:])]
    assert found.tolist() == np.concatenate(alone).tolist()


def _one_by_one(weights, parts, gold, bounds, bits):
    """An epoch that decodes every group of sequences on its own; the number of groups."""
    rows, groups = tagger.features(parts, bounds, bits), range(0, len(bounds) - 1, tagger.SEQUENCES)
    for k in groups:
        own = bounds[k : k + tagger.SEQUENCES + 1]
        some, want, cut = rows[own[0] : own[-1]], gold[own[0] : own[-1]], own - own[0]
        got = tagger.decode(weights[some].sum(1), weights[-4:], cut)
        if (got != want).any():
            for tags, step in ((want, 1.0), (got, -1.0)):
                np.add.at(weights, (some, tags[:, None]), step)
                np.add.at(weights, (len(weights) - 4 + tagger._before(tags, cut), tags), step)
    return len(groups)


def test_groups_that_are_right_are_decoded_together(monkeypatch):
    rng = random.Random(7)
    names = _names(rng, 40)
    texts = [*_sentences(rng, names, 600), None, "", "a " * 700, "Ünïcode 漢字 🙂 Inc."]
    spans = [[{"start": t.find(n), "end": t.find(n) + len(n) - 1} for n in names if n in t] if t else [] for t in texts]
    monkeypatch.setattr(tagger, "SLICE_BYTES", 30_000)
    table = pa.table({"text": texts, "spans": spans})
    (batch,) = table.to_batches()
    weights = np.zeros((2**12 + 4, 3))
    expected, calls, decode = weights.copy(), [], tagger.decode
    _, _, _, parts, gold, bounds = tagger.read(texts, spans)
    for _ in range(4):
        groups = _one_by_one(expected, parts, gold, bounds, 12)
        calls.clear()
        with monkeypatch.context() as counted:
            counted.setattr(tagger, "decode", lambda *a: calls.append(1) or decode(*a))
            for some in tagger._taught(batch):
                tagger.epoch(weights, *some, 12)
        assert np.array_equal(weights, expected)
        weights, expected = weights / 3, expected / 3
    assert len(calls) < groups / 2


def test_words_are_those_of_the_pattern():
    texts = ["One_2 ²½ x​z İΣ!? a.b ς", None, "", "\n", "漢字🙂🙂 é"]
    row, begin, end, _, _, bounds = tagger.read(texts)
    found = [(i, m.start(), m.end() - 1, m.group()) for i, t in enumerate(texts) for m in tagger._TOKEN.finditer(t or "")]
    assert list(zip(row, begin, end)) == [f[:3] for f in found]
    ends = [k + 1 for k, f in enumerate(found) if f[3] in ".!?" or k + 1 == len(found) or found[k + 1][0] != f[0]]
    assert bounds.tolist() == [0, *ends]
