"""Language identification by interpolated Kneser-Ney character models, one per language.

Letters are lower-cased, everything else becomes one space; a character 4-gram is four
16-bit symbols packed in 64 bits. Its hash (a bijection of the packed symbols) is the key of
sorted arrays that hold, for all languages side by side, log-probabilities of n-grams and
log back-off weights of contexts. All 4-grams of all training documents are counted by
Spark (combined per task before the shuffle); lower orders follow from the distinct 4-grams.

A text gets the language of lowest cross-entropy per character. Rejection is calibrated: every eighth text with a
language, by its checksum, is scored by a model that is counted without those texts. Per language the excess over the mean
that one in a hundred passes, and over all languages the mean of what these have beyond it (an exponential tail), give
the limit that a share ``rate`` of such texts would pass. The final model is counted from all texts.

One way for all sizes: no n-gram is left out, and the arrays are files in the shared folder (``hash_arrays``), cut by
contexts and mapped by workers. Spark counts the orders and deals whole contexts to tasks, each of which writes its file
over those of the order below. The driver gets a few numbers a language. A line of the arrays has a number for each
language, so files are cut smaller the more languages there are.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected;
rows without lang or text teach nothing; with nothing to learn from, all is ``und``; ties go
to the first language by name; extra columns are ignored or kept as they are. With fewer than 200 texts set apart a
language has the limit of all languages; with fewer than 200 in all, the default one.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, hash_arrays, textcore
from newslens.llm.textcore import U64
from newslens.settings import shared_dir, stored

ORDER = 4
FALSE_REJECTIONS = 1e-5
APART = 8  # one text in so many sets the limits
TAIL = 0.01
LEAST_TEXTS, LEAST_BEYOND = 200, 20
USUAL, BEYOND = 0.15, 0.2  # where too few texts are set apart
UNIT_Z = 6.0
UNKNOWN = "und"
_SPACE = 0x20
_SHIFT = U64(16)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every 16-bit code point, and whether it is a letter."""
    symbol = np.full(1 << 16, _SPACE, np.uint16)
    letter = np.zeros(1 << 16, bool)
    for cp in range(1 << 16):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            small = chr(cp).lower()
            symbol[cp] = ord(small) if len(small) == 1 and ord(small) < 1 << 16 else cp
            letter[cp] = kind == "L"
    return symbol, letter


def _symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows, the bounds of rows, and whether each row has a letter."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text = data.tobytes().decode("utf-8", "replace")
    bounds = heads[offsets]
    if len(text) != bounds[-1]:  # not valid UTF-8: row by row
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        text, bounds = "".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    code = np.frombuffer(text.encode("utf-32-" + ("le" if sys.byteorder == "little" else "be")), np.uint32)
    symbol, letter = _tables()
    small = np.minimum(code, 0xFFFF)
    out, is_letter = symbol[small], letter[small]
    if len(code) and code.max() > 0xFFFF:
        for cp in np.unique(code[code > 0xFFFF]).tolist():
            known = unicodedata.category(chr(cp))[0] == "L"
            out[code == cp] = 0xE000 + cp % 0x1900 if known else _SPACE
            is_letter[code == cp] = known
    seen = np.concatenate([[0], np.cumsum(is_letter)])
    return out, bounds, seen[bounds[1:]] > seen[bounds[:-1]]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams of all rows, bounds of rows, whether each row has a letter.

    A row is read with three spaces before and one after; runs of spaces count once.
    """
    symbols, bounds, has_letter = _symbols(data, offsets)
    first = np.zeros(len(symbols) + 1, bool)
    first[bounds] = True
    space = symbols == _SPACE
    follows = np.concatenate([[True], space[:-1]]) if len(space) else space
    keep = ~(space & (follows | first[:-1]))
    kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
    rows = len(bounds) - 1
    padded = np.full(kept[-1] + ORDER * rows + ORDER, _SPACE, U64)
    row_of = np.repeat(np.arange(rows), np.diff(kept))
    padded[np.arange(kept[-1]) + ORDER * row_of + ORDER - 1] = symbols[keep]
    packed = padded[: len(padded) - 3] << U64(48)
    for k in range(1, ORDER):
        packed |= padded[k : len(padded) - 3 + k] << U64(48 - 16 * k)
    count = np.diff(kept) + 1
    starts = kept[:-1] + ORDER * np.arange(rows)
    ends = np.concatenate([[0], np.cumsum(count)])
    return packed[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], count)], ends, has_letter


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram (packed, as a signed long), n over all rows that have both columns, and fit, n without the texts set apart."""
    rows = _labelled(docs, text, lang)

    def count(batches):
        for batch in batches:
            group = np.array(batch.column("lang").to_pylist(), object), np.array(batch.column("apart").to_pylist(), bool)
            for first, end, data, offsets in textcore.slices(batch.column("text"), 1 << 21):
                packed, bounds, _ = grams(data, offsets)
                names, number = np.unique(group[0][first:end].astype(str), return_inverse=True)
                of = np.repeat(2 * number + group[1][first:end], np.diff(bounds))
                for i in np.unique(of).tolist():
                    keys, n = np.unique(packed[of == i], return_counts=True)
                    fit = np.zeros(len(n), np.int64) if i % 2 else n.astype(np.int64)
                    columns = [pa.array([names[i // 2]] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(fit)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n", "fit"])

    counted = rows.mapInArrow(count, "lang string, gram long, n long, fit long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("fit").alias("fit"))


def _labelled(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Text and language of the rows that have both; ``apart``: whether limits are set by the row."""
    rows = docs.select(F.col(frames.quoted(lang)).cast("string").alias("lang"), F.col(frames.quoted(text)).cast("string").alias("text"))
    return rows.where("lang is not null and text is not null").withColumn("apart", F.crc32("text") % APART == 0)


def _discount(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once and twice else 0.5


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and a few numbers a language. A file holds all n-grams of its contexts: hashes ``key``
    with ``logp`` and ``context`` with ``backoff``, one column per language."""

    folder: str
    langs: list[str]
    bits: list[int]  # leading bits of a context's hash that name the file, by order from 1
    mean: np.ndarray
    deviation: np.ndarray
    usual: np.ndarray  # excess that a share TAIL of the texts set apart passes
    beyond: float  # how far these pass it in the mean

    def log_probs(self, packed: np.ndarray, n: int = ORDER) -> np.ndarray:
        """One line per n-gram, one column per language."""
        size = len(self.langs)
        out = np.full((len(packed), size), -16 * np.log(2), np.float32)
        if n == 0 or not len(packed):
            return out
        contexts = textcore.mix(packed >> _SHIFT)
        number = (contexts >> U64(64 - self.bits[n - 1])).astype(np.int64)
        by = np.argsort(number, kind="stable")
        begins = np.flatnonzero(np.diff(number[by], prepend=-1)).tolist()
        known, weight = np.zeros(len(packed), bool), np.zeros((len(packed), size), np.float32)
        for a, b in zip(begins, [*begins[1:], len(by)], strict=True):
            own = by[a:b]
            part = hash_arrays.load(self.folder, f"order{n}-{number[own[0]]}")
            if part is None:
                continue
            at, has = _find(part["key"], textcore.mix(packed[own]))
            out[own[has]] = part["logp"].reshape(-1, size)[at[has]]
            known[own] = has
            own = own[~has]
            of, seen = _find(part["context"], contexts[own])
            weight[own[seen]] = part["backoff"].reshape(-1, size)[of[seen]]
        rest = np.flatnonzero(~known)
        if len(rest):
            out[rest] = weight[rest] + self.log_probs(packed[rest] & U64((1 << 16 * (n - 1)) - 1), n - 1)
        return out

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cost per character of each row in each language, lengths, and whether rows have a letter."""
        packed, bounds, has_letter = grams(data, offsets)
        distinct, of = np.unique(packed, return_inverse=True)
        cost = -np.add.reduceat(self.log_probs(distinct)[of], bounds[:-1], axis=0, dtype=np.float64)
        length = np.diff(bounds)
        return cost / length[:, None], length, has_letter

    def excess(self, lowest: np.ndarray, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """How far entropies are above the mean of their language, short texts measured by a wider unit."""
        return (lowest - self.mean[best]) / (1 + UNIT_Z * self.deviation[best] / np.sqrt(length))

    def classify(self, column, rate: float) -> tuple[list, list, list]:
        """Language, score and rejection of every row of a text column."""
        langs, scores, rejected = [], [], []
        limit = self.usual + self.beyond * np.log(TAIL / rate)
        for _, _, data, offsets in textcore.slices(column):
            entropy, length, has_letter = self.entropies(data, offsets)
            best = entropy.argmin(1)
            lowest = entropy[np.arange(len(best)), best]
            evidence = length / (1 + length / 40)  # characters are not independent
            score = 1 / np.exp(np.minimum((lowest[:, None] - entropy) * evidence[:, None], 0)).sum(1)
            langs += [self.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), has_letter.tolist())]
            scores += np.where(has_letter, score, 0.0).tolist()
            rejected += (~has_letter | (self.excess(lowest, best, length) > limit[best])).tolist()
        return langs, scores, rejected


def _arrays(model: Model, k: int, part: pa.Table, discount: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The file of some contexts with all their n-grams, and counts and costs of these: interpolated Kneser-Ney over
    the lower order, whose files are there."""
    size = len(model.langs)
    keys, row = np.unique(part.column("gram").to_numpy().view(U64), return_inverse=True)
    count = np.zeros((len(keys), size))
    count[row, part.column("lang").to_numpy()] = part.column("n").to_numpy()
    contexts = keys >> _SHIFT
    starts = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]]))
    of = np.repeat(np.arange(len(starts)), np.diff([*starts.tolist(), len(keys)]))
    total = np.add.reduceat(count, starts)
    left = np.where(total > 0, np.add.reduceat(np.minimum(count, discount), starts) / np.maximum(total, 1), 1)
    lower = np.exp(model.log_probs(keys & U64((1 << 16 * (k - 1)) - 1), k - 1).astype(np.float64))
    logp = np.log(np.maximum(count - discount, 0) / np.maximum(total, 1)[of] + left[of] * lower)
    hashed, seen = textcore.mix(keys), textcore.mix(contexts[starts])
    by, ctx = np.argsort(hashed), np.argsort(seen)
    columns = {"key": hashed[by], "logp": logp[by].astype(np.float32).ravel()}
    columns |= {"context": seen[ctx], "backoff": np.log(left)[ctx].astype(np.float32).ravel()}
    return columns, count, -logp


def _build(counts: DataFrame, langs: list[str], bits: int | None = None) -> Model:
    """Write the model of (lang number, gram, n). Every task gets whole contexts, each of 65 536 n-grams a language at
    most; lower orders count in how many ways an n-gram is preceded."""
    size = len(langs)
    model = Model(shared_dir(counts.sparkSession, "language"), langs, [], np.zeros(size), np.zeros(size), np.full(size, USUAL), BEYOND)
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram")
        orders[k] = stored(orders[k + 1].groupBy("lang", tail).agg(F.count("*").alias("n")), "order")
    for k in range(1, ORDER + 1):
        discount, rows = np.full(size, 0.5), 0
        seen = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count("*")]
        for row in orders[k].groupBy("lang").agg(*seen).collect():  # a row a language
            discount[row[0]] = _discount(row[1], row[2])
            rows += row[3]
        model.bits.append(bits or hash_arrays.bits_for(rows * size // 8))
        sums = _write_order(orders[k], model, k, discount)
    for row in sums.groupBy("lang").agg(F.sum("n"), F.sum("cost"), F.sum("square")).collect():
        mean = row[2] / row[1]
        model.mean[row[0]], model.deviation[row[0]] = mean, np.sqrt(max(row[3] / row[1] - mean**2, 0.0))
    return model


def _write_order(counts: DataFrame, model: Model, k: int, discount: np.ndarray) -> DataFrame:
    shift = U64(64 - model.bits[k - 1])

    def place(batches):
        for batch in batches:
            context = batch.column("gram").to_numpy().view(U64) >> _SHIFT
            number = (textcore.mix(context) >> shift).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], names=[*batch.schema.names, "bucket"])

    def save(batches):
        for (number,), part in hash_arrays.by_file(batches, ["bucket"]):
            columns, count, cost = _arrays(model, k, part, discount)
            hash_arrays.save(model.folder, f"order{k}-{number}", columns)
            sums = [count.sum(0), (count * cost).sum(0), (count * cost**2).sum(0)]
            own = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *[pa.array(s[own]) for s in sums]], names=["lang", "n", "cost", "square"])

    placed = counts.select("lang", "gram", "n").mapInArrow(place, "lang int, gram long, n long, bucket long")
    placed = placed.repartition("bucket").sortWithinPartitions("bucket", "gram", "lang")
    return stored(placed.mapInArrow(save, "lang int, n double, cost double, square double"), "language-files")


def _calibrated(model: Model, trial: Model, rows: DataFrame) -> Model:
    """The model with the limits that texts set apart give, as ``trial``, which has not seen them, scores them."""

    def measure(batches):
        for batch in batches:
            labels = np.array(batch.column("lang").to_pylist(), object)
            for first, end, data, offsets in textcore.slices(batch.column("text")):
                entropy, length, has_letter = trial.entropies(data, offsets)
                best = entropy.argmin(1)
                right = has_letter & (np.array(trial.langs, object)[best] == labels[first:end])
                excess = trial.excess(entropy[np.arange(len(best)), best], best, length)
                yield pa.RecordBatch.from_arrays([pa.array(best[right].astype(np.int32)), pa.array(excess[right])], names=["lang", "excess"])

    found = stored(rows.select("lang", "text").mapInArrow(measure, "lang int, excess double"), "excess")
    at = F.percentile_approx("excess", F.lit(1 - TAIL), F.lit(10_000))
    pooled, texts = found.agg(at, F.count("*")).first()
    usual = np.full(len(model.langs), pooled if texts >= LEAST_TEXTS else USUAL)
    for row in found.groupBy("lang").agg(at, F.count("*")).collect():
        if row[2] >= LEAST_TEXTS:
            usual[model.langs.index(trial.langs[row[0]])] = row[1]
    by_trial = F.array(*[F.lit(float(usual[model.langs.index(name)])) for name in trial.langs])
    more = F.col("excess") - F.get(by_trial, F.col("lang"))
    n, mean = found.where(more > 0).agg(F.count("*"), F.avg(more)).first()
    return replace(model, usual=usual, beyond=mean if n >= LEAST_BEYOND else BEYOND)


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", bits: int | None = None) -> Model:
    """Count all 4-grams of the rows with a language and write the model; set its limits. ``bits`` fixes the number of files."""
    counted = stored(count_grams(docs, text, lang), "grams")
    langs = sorted(row.lang for row in counted.select("lang").distinct().collect())

    def built(names: list[str], n: str) -> Model:
        number = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("lang")) - 1
        return _build(counted.where(F.col(n) > 0).select(number.cast("int").alias("lang"), "gram", F.col(n).alias("n")), names, bits)

    if not langs:
        return Model("", [], [1] * ORDER, *[np.zeros(0)] * 3, BEYOND)
    model = built(langs, "n")
    fitted = sorted(row.lang for row in counted.where("fit > 0").select("lang").distinct().collect())
    if not fitted:
        return model
    return _calibrated(model, built(fitted, "fit"), _labelled(docs, text, lang).where("apart"))


def _classified(packed: DataFrame, model: Model, rate: float, with_text: bool) -> DataFrame:
    if not 0 < rate <= TAIL:
        raise ValueError(f"a rate of false rejections above 0 and up to {TAIL}")
    kept = ["row", "text"] if with_text else ["row"]
    added = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    schema = T.StructType([*[packed.schema[c] for c in kept], *added.fields])
    names = schema.names

    def classify(batches):
        for batch in batches:
            if batch.num_rows:
                if model.langs:
                    langs, scores, rejected = model.classify(batch.column("text"), rate)
                else:
                    n = batch.num_rows
                    langs, scores, rejected = [UNKNOWN] * n, [0.0] * n, [True] * n
                columns = [batch.column(c) for c in kept]
                columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed.mapInArrow(classify, schema)


def identify(
    docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, rate: float = FALSE_REJECTIONS
) -> DataFrame:
    """The ``keep`` columns (default: all) with lang_pred, score and rejected."""
    keep = docs.columns if keep is None else keep
    found = _classified(frames.pack(docs, text, keep), model, rate, text in keep)
    added = {c: F.col(c) for c in ("lang_pred", "score", "rejected")}
    return frames.unpack(found, text, keep, **added)


def drop_rejected(docs: DataFrame, model: Model, *, text: str = "text", rate: float = FALSE_REJECTIONS) -> DataFrame:
    """The documents that some language accepts, with their own columns."""
    found = _classified(frames.pack(docs, text), model, rate, True)
    return frames.unpack(found.where(~F.col("rejected")), text, docs.columns)


def held_out(doc_id: str = "doc_id"):
    """True for the third of documents that nothing may be learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
