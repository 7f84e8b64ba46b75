"""Scores of texts by an interpolated modified Kneser-Ney model of words, counted over all training texts.

Tokens are the words between ASCII white space, A-Z lower-cased, and one end mark for each text; contexts begin with
``order - 1`` start marks. Nothing is pruned and no count is left out, so the model grows with the corpus: it
lives as sorted hash arrays in the shared folder (``hash_arrays``), and workers map its files into memory.

Training reads the texts twice (three times from order 3 on). The first pass counts the n-grams of each order:
only their 64-bit hashes are shuffled, summed within tasks first. In the later passes every n-gram looks up its own
count ``c`` and adds ``1 / c`` to what is counted once per distinct n-gram: continuations of its suffix, and the
numbers of continuations seen once, twice or more of its context. Sums over all occurrences are whole numbers but for
rounding, and are rounded. So neither contexts nor suffixes of n-grams are ever shuffled, and a frequent word or
context is summed within tasks, not gathered in one.

Discounts are those of Chen and Goodman from the counts of counts of each order; where these are not all there (or give
no proper discount), 0.5, 1 and 1.5. The lowest order is interpolated with a uniform one over the words and one unknown.

Defined results: a null or empty text is its end mark; white space and NUL never are in a word's way; repeated rows are
counted as often; without training texts every word has probability 1 (one unknown word is all there is); no rows give
no rows; other columns are carried or ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, hash_arrays, textcore
from newslens.settings import shared_dir, stored

U64 = np.uint64
ORDER = 2
PART_TOKENS = 1 << 20
SLICE_BYTES = 1 << 20
START, END = U64(0x51A27C0FFEE51A27), U64(0xE11DE11DE11DE11D)
_MANY = U64(0x9E3779B97F4A7C15)
_SPACE = 0x20


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    table[0x09:0x0E] = _SPACE
    return table


_LOWER = _lower_table()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, and the bounds of rows."""
    low = _LOWER[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != _SPACE
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    bounds = np.searchsorted(starts, offsets) + np.arange(len(offsets))
    out = np.empty(bounds[-1], U64)
    word = np.ones(len(out), bool)
    word[bounds[1:] - 1] = False
    out[word] = textcore.span_hashes(low, starts, ends)
    out[~word] = END
    return out, bounds


def joined(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return textcore.mix(context * _MANY + token)


def grams(token: np.ndarray, bounds: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By length from 1: hashes of the n-grams that end in each token; by length from 1: of the contexts before it."""
    back, last = [], token
    for _ in range(order - 1):  # the words one, two, ... before
        before = np.empty_like(token)
        before[1:] = last[:-1]
        before[bounds[:-1]] = START
        back.append(before)
        last = before
    contexts = []
    for n in range(1, order):
        context = back[n - 1]
        for k in range(n - 2, -1, -1):
            context = joined(context, back[k])
        contexts.append(context)
    return [token, *[joined(c, token) for c in contexts]], contexts


def word_numbers(token: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words and the start mark, in order, and by number in them: every token, and the word before it."""
    own, of = np.unique(np.append(token, START), return_inverse=True)
    before = np.empty(len(token), np.int64)
    before[1:] = of[:-2]
    before[bounds[:-1]] = of[-1]
    return own, of[:-1], before


def _parts(batches: Iterator[pa.RecordBatch], most: int = PART_TOKENS) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Rows, tokens and bounds of about ``most`` tokens at a time; a text is never cut."""
    rows, found, counts, size = [], [], [], 0

    def whole():
        return rows, np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    for batch in batches:
        for first, end, data, offsets in textcore.slices(batch.column("text"), SLICE_BYTES):
            token, bounds = tokens(data, offsets)
            rows.append(batch.slice(first, end - first))
            found.append(token)
            counts.append(np.diff(bounds))
            size += len(token)
            if size >= most:
                yield whole()
                rows, found, counts, size = [], [], [], 0
    if rows:
        yield whole()


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all of them. ``discounts``: by order from 1."""

    folder: str
    bits: int
    order: int
    discounts: list[tuple[float, float, float]]
    tokens: int  # N, all training tokens
    words: int  # V, distinct ones
    continuations: int  # sum of the lowest order's counts
    rest: float  # what the lowest order leaves to unknown words, times the words and one


def discounts_of(counts: list[int]) -> tuple[float, float, float]:
    """From how many n-grams were seen once, twice, three and four times."""
    one, two, three, four = counts
    if one and two and three:
        y = one / (one + 2 * two)
        found = (1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three)
        if all(0 < d <= k for k, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


def _discounted(count: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    by = np.array([0.0, *discounts])
    return np.maximum(count - by[np.minimum(count, 3).astype(np.int64)], 0)


def _write(rows: DataFrame, model_dir: str, bits: int, table: str, values: list[str]) -> dict[int, list[int]]:
    """Sum ``values`` (whole numbers but for rounding) by level and key, sorted by Spark, and write the files. By level:
    rows, those of value 1 to 4 in the last column, and the sums of all columns."""
    placed = rows.withColumn("bucket", hash_arrays.bucket("key", bits)).repartition("bucket")
    placed = placed.sortWithinPartitions("bucket", "level", "key")  # a sort spills; a table of all keys would not fit
    names = ["level", "rows", *[f"c{k}" for k in range(1, 5)], *[f"s_{v}" for v in values]]

    def save(batches):
        for (number, level), part in hash_arrays.by_file(batches, ["bucket", "level"]):
            key = part.column("key").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            columns = {"key": key[first].view(U64)}
            own = {v: np.rint(np.add.reduceat(part.column(v).to_numpy(), first)).astype(np.int64) for v in values}
            for v in values:
                columns |= hash_arrays.narrow(v, own[v])
            hash_arrays.save(model_dir, f"{table}{level}-{number}", columns)
            last = own[values[-1]]
            row = [level, int((last > 0).sum()), *[int((last == k).sum()) for k in range(1, 5)], *[int(own[v].sum()) for v in values]]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=names)

    written = stored(placed.mapInArrow(save, ", ".join(f"{n} long" for n in names)), "lm-files")
    sums = written.groupBy("level").agg(*[F.sum(n) for n in names[1:]]).collect()  # a row per order
    return {r[0]: [int(x) for x in r[1:]] for r in sums}


def train(docs: DataFrame, *, text: str = "text", order: int = ORDER) -> Model:
    """Count the model over all rows of ``docs``."""
    if order < 2:
        raise ValueError("an order of 2 at least")
    rows = docs.select(F.col(frames.quoted(text)).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = hash_arrays.bits_for(size // 6)
    folder = shared_dir(docs.sparkSession, "lm")
    at = lambda table, keys, columns: hash_arrays.lookup(folder, table, bits, keys, columns)

    def counted(batches):
        for _, token, bounds in _parts(batches):
            for level, keys in enumerate(grams(token, bounds, order)[0][1:], 2):
                keys, n = np.unique(keys, return_counts=True)
                columns = [pa.array(np.full(len(keys), level, np.int8)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["level", "key", "n"])

    found = _write(rows.mapInArrow(counted, "level byte, key long, n int"), folder, bits, "raw", ["n"])
    counts = {order: found.get(order, [0] * 5)}

    def continued(batches):
        for _, token, bounds in _parts(batches):
            keys = grams(token, bounds, order)[0]
            for level in range(2, order):
                own, of = np.unique(keys[level - 1], return_inverse=True)
                n = np.bincount(of, 1 / at(f"raw{level + 1}", keys[level], ["n"])[0])
                columns = [pa.array(np.full(len(own), level, np.int8)), pa.array(own.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["level", "key", "n"])

    if order > 2:
        found = _write(rows.mapInArrow(continued, "level byte, key long, n double"), folder, bits, "next", ["n"])
        counts |= {k: found.get(k, [0] * 5) for k in range(2, order)}

    kinds = {"level": pa.int8(), "key": pa.int64(), "raw": pa.int64(), "total": pa.float64(), "one": pa.float64(),
             "two": pa.float64(), "more": pa.float64(), "n": pa.float64()}

    def followed(batches):
        """Per word: how often it was seen, its continuations as a context (level 1), and as a word (n)."""
        for _, token, bounds in _parts(batches):
            keys, contexts = grams(token, bounds, order)
            for level in range(2, order + 1):
                raw = at(f"raw{level}", keys[level - 1], ["n"])[0]
                adjusted = raw if level == order else at(f"next{level}", keys[level - 1], ["n"])[0]
                share = 1 / raw
                if level == 2:
                    own, word, of = word_numbers(token, bounds)
                else:
                    own, of = np.unique(contexts[level - 2], return_inverse=True)
                sums = [np.bincount(of, adjusted * share, len(own)), *[np.bincount(of, share * (adjusted == k), len(own)) for k in (1, 2)]]
                sums.append(np.bincount(of, share * (adjusted > 2), len(own)))
                seen = np.bincount(word, minlength=len(own)) if level == 2 else np.zeros(len(own), np.int64)
                n = np.bincount(word, share, len(own)) if level == 2 else np.zeros(len(own))
                columns = [np.full(len(own), level - 1, np.int8), own.view(np.int64), seen, *sums, n]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    schema = "level byte, key long, raw long, total double, one double, two double, more double, n double"
    words = _write(rows.mapInArrow(followed, schema), folder, bits, "words", list(kinds)[2:]).get(1, [0] * 11)
    counts[1] = words[:5]
    discounts = [discounts_of(counts[k][1:5]) for k in range(1, order + 1)]
    distinct, (one, two) = words[0], words[1:3]
    rest = one * discounts[0][0] + two * discounts[0][1] + (distinct - one - two) * discounts[0][2]
    return Model(folder, bits, order, discounts, words[5], distinct, words[-1], rest)


def log_probabilities(model: Model, token: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of every token's probability, and how often it was seen in training."""
    at = lambda table, keys, columns: hash_arrays.lookup(model.folder, table, model.bits, keys, columns)
    keys, contexts = grams(token, bounds, model.order)
    names = ["raw", "n", "total", "one", "two", "more"]
    own, word, before = word_numbers(token, bounds)
    raw, n, *of_words = at("words1", own, names)
    size = len(token)
    raw, n = raw[word], n[word]
    if model.continuations:
        p = (_discounted(n, model.discounts[0]) + model.rest / (model.words + 1)) / model.continuations
    else:
        p = np.ones(size)
    for level in range(2, model.order + 1):
        table = f"raw{level}" if level == model.order else f"next{level}"
        count = at(table, keys[level - 1], ["n"])[0]
        own = [x[before] for x in of_words] if level == 2 else at(f"words{level - 1}", contexts[level - 2], names[2:])
        total, *kinds = own
        known = np.maximum(total, 1)
        back = sum(d * x for d, x in zip(model.discounts[level - 1], kinds, strict=True)) / known
        p = np.where(total > 0, _discounted(count, model.discounts[level - 1]) / known + back * p, p)
    return np.log10(p), raw


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_tokens, n_known, train_tokens, base_score (add-half unigrams) and score (the model),
    both log10 probabilities of the whole text."""
    keep = docs.columns if keep is None else keep
    rows = frames.pack(docs, text, keep)
    added = T.StructType.fromDDL("n_tokens long, n_known long, base_score double, score double")
    schema = T.StructType([rows.schema["row"], rows.schema["text"], *added.fields])
    carried = text in keep

    def work(batches):
        for parts, token, bounds in _parts(batches, PART_TOKENS // 2):
            p, seen = log_probabilities(model, token, bounds)
            base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
            columns = [np.add.reduceat(x, bounds[:-1]) for x in ((seen > 0).astype(np.int64), base, p)]
            columns = [pa.array(np.diff(bounds)), *map(pa.array, columns)]
            first = 0
            for part in parts:
                own = part.column("text") if carried else pa.nulls(part.num_rows, part.schema.field("text").type)
                some = [c.slice(first, part.num_rows) for c in columns]
                yield pa.RecordBatch.from_arrays([part.column("row"), own, *some], names=schema.names)
                first += part.num_rows

    done = rows.mapInArrow(work, schema)
    found = {c: F.col(c) for c in added.names}
    return frames.unpack(done, text, keep, train_tokens=F.lit(model.tokens).cast("long"), **found)


def perplexity(scored: DataFrame) -> DataFrame:
    """Scored rows with ``perplexity`` per token."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op13(spark, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out.alias("held_out"))
    scored = score(docs, train(docs.where("not held_out")), keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
