"""Text quality by supervised subword embeddings.

Features of a text are its words (between white space), its pairs of words and all its byte
n-grams of three, hashed to three tables of buckets; two equal words in a row, or with one word
between, are one feature each whatever the word. Each bucket has a vector; a text is the mean of the vectors of
its features; a softmax layer on it gives the class. Vectors and layer are learnt together by
stochastic gradient descent in numpy, in one task, from a bounded sample of labelled rows
(``sample_rows``, those of smallest hash; the whole text of each).

The layer is linear, so scoring needs one number per bucket: the difference of the logits that its
vector contributes. All texts are scored whole by the tasks, with that table of fixed size.

Defined results: a null text counts as empty; an empty text has the score of the bias alone; with no
labelled row the score is 0.5; labels other than 0 and 1 and rows without text teach nothing, a repeated
label counts again; extra columns are ignored or kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, textcore
from newslens.llm.langid import held_out
from newslens.llm.textcore import U64

BITS = 16  # buckets of each table: 2**BITS
SIZE = 16
EPOCHS = 5
RATE = 0.5
SAMPLE_ROWS = 8192
_PART = np.arange(256) <= 32  # white space and control bytes part words


def _in_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Put each row's values (``rows`` their bounds) at its place."""
    count = np.diff(rows)
    out[np.repeat(at - rows[:-1], count) + np.arange(len(values))] = values


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all rows (words, pairs, echoes, n-grams of every row) and bounds of rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_PART[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    hashes = textcore.span_hashes(data, starts, ends)
    word_rows = np.searchsorted(starts, offsets)
    words = (hashes >> U64(64 - BITS)).astype(np.int64)
    # pairs of words; a word that repeats the one before, or the one before that, is one feature each
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(word_rows))
    next_ = np.flatnonzero(row[1:] == row[:-1]) + 1
    pair = (textcore.mix(hashes[next_ - 1] * U64(31) + hashes[next_]) >> U64(64 - BITS)).astype(np.int64)
    pair = np.where(hashes[next_] == hashes[next_ - 1], 0, np.maximum(pair, 2)) + (1 << BITS)
    pair_rows = np.searchsorted(next_, word_rows)
    echo = np.flatnonzero((row[2:] == row[:-2]) & (hashes[2:] == hashes[:-2])) + 2
    echo_rows = np.searchsorted(echo, word_rows)
    wide = data.astype(np.uint32)
    key = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) if len(data) > 2 else np.zeros(0, np.uint32)
    gram_of = ((key * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64) + (2 << BITS)
    n_grams = np.maximum(np.diff(offsets) - 2, 0)
    gram_rows = np.concatenate([[0], np.cumsum(n_grams)])
    grams = gram_of[np.repeat(offsets[:-1] - gram_rows[:-1], n_grams) + np.arange(gram_rows[-1])]
    parts = [(word_rows, words), (pair_rows, pair), (echo_rows, np.full(len(echo), (1 << BITS) + 1)), (gram_rows, grams)]
    bounds = np.sum([rows for rows, _ in parts], axis=0)
    out, at = np.empty(bounds[-1], np.int64), bounds[:-1].copy()
    for rows, values in parts:
        _in_rows(out, at, rows, values)
        at += np.diff(rows)
    return out, bounds


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 1) -> tuple[np.ndarray, float]:
    """Logit difference per bucket, and of the bias, after gradient descent on (buckets, shares) of texts."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (3 << BITS, SIZE))
    layer, bias = random.normal(0, 0.1, (2, SIZE)), np.zeros(2)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS if len(set(labels)) else 0):
        for i in random.permutation(len(rows)).tolist():
            rate = RATE * (1 - done / steps) + 1e-3
            done += 1
            at, share = rows[i]
            mean = share @ vectors[at] if len(at) else np.zeros(SIZE)
            logit = layer @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer.T @ p
            layer -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            if len(at):
                # a feature moves by its share, scaled so that rare features of long texts still learn
                vectors[at] -= rate * 50 * share[:, None] * back
    return (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> tuple[np.ndarray, float]:
    """Learn from ``sample_rows`` labelled rows at most. One task fits; its table comes back as one row."""
    known = labels.select(F.col(frames.quoted(doc_id)).alias("id"), F.col(frames.quoted(label)).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows)
    texts = docs.select(F.col(frames.quoted(doc_id)).alias("id"), F.col(frames.quoted(text)).cast("string").alias("text"))
    rows = texts.where("text is not null").join(known, "id").select("label", "text")

    def collect(batches):
        for batch in batches:
            own = batch.column("label").to_pylist()
            for first, _, data, offsets in textcore.slices(batch.column("text")):
                found, bounds = features(data, offsets)
                for k in range(len(bounds) - 1):
                    at, n = np.unique(found[bounds[k] : bounds[k + 1]], return_counts=True)
                    row = [own[first + k], at.astype(np.int32).tobytes(), (n / max(1, n.sum())).astype(np.float32).tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row[0]], pa.int32()), pa.array([row[1]], pa.binary()), pa.array([row[2]], pa.binary())],
                        names=["label", "buckets", "shares"],
                    )

    found = rows.mapInArrow(collect, "label int, buckets binary, shares binary")

    def learn(batches):
        own = [r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("label", "buckets", "shares")], strict=True)]
        own.sort()  # the order of rows must not matter
        rows = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for _, b, s in own]
        table, bias = fit(rows, [r[0] for r in own])
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([bias])], names=["table", "bias"])

    model = found.repartition(1).mapInArrow(learn, "table binary, bias double")  # of the bounded sample
    got = model.collect()
    if not got:
        return np.zeros(3 << BITS, np.float32), 0.0
    return np.frombuffer(got[0].table, np.float32), got[0].bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with score, the probability of label 1, and predicted."""
    keep = docs.columns if keep is None else keep
    packed = frames.pack(docs, text, keep)
    kept = ["row", "text"] if text in keep else ["row"]
    schema = T.StructType([*[packed.schema[c] for c in kept], T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 3 * 2**BITS numbers

    def apply(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table, bias = sent.value
            out = []
            for _, _, data, offsets in textcore.slices(batch.column("text")):
                found, bounds = features(data, offsets)
                sums = np.concatenate([[0.0], np.cumsum(table[found], dtype=np.float64)])
                mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
                out.append(1 / (1 + np.exp(-np.clip(mean + bias, -50, 50))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(np.concatenate(out))], names=schema.names)

    found = packed.mapInArrow(apply, schema)
    predicted = (F.col("score") >= 0.5).cast("int")
    return frames.unpack(found, text, keep, score=F.col("score"), predicted=predicted)


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    found = score(docs, train(docs, labels), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
