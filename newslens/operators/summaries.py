"""Extractive summaries: sentences of the most probable words (SumBasic scoring,
Nenkova & Vanderwende 2005), put back in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import fixed_values as fv
from newslens.functions.columns import let
from newslens.functions.text import SENTENCE_END, WORD, sentences

MIN_SENTENCE_WORDS = 3
PLACES = 6
_SENTENCES = T.ArrayType(
    T.StructType()
    .add("pos", T.IntegerType())
    .add("n_words", T.IntegerType())
    .add("mass", T.LongType())
    .add("text_words", T.LongType())
)
_KEPT = "array<struct<pos:int,taken:bigint,n_words:bigint>>"
_MOST_WORDS = 1_000_000  # of the texts that are counted at once
_MASS = pa.list_(pa.struct([("pos", pa.int32()), ("n_words", pa.int32()), ("mass", pa.int64()), ("text_words", pa.int64())]))


def _some_masses(texts: pa.ListArray) -> pa.ListArray:
    """For each row's texts, given as words and sentence ends in order: the sentences that have
    words, and the sum of how often each of their words is in the row."""
    n_rows, of_text = len(texts), texts.flatten()
    row_of_text = np.repeat(np.arange(n_rows), np.asarray(pc.list_value_length(texts)))
    size = np.asarray(pc.list_value_length(of_text))
    coded = of_text.flatten().dictionary_encode()
    ends = pc.is_in(pc.utf8_slice_codeunits(coded.dictionary, 0, 1), value_set=pa.array([".", "!", "?"], coded.dictionary.type))
    code = np.asarray(coded.indices).astype(np.int64)
    is_end = np.asarray(ends.cast(pa.uint8())).astype(bool)[code]
    first = np.repeat(np.cumsum(size) - size, size)
    passed = np.cumsum(is_end) - is_end
    pos = passed - passed[first]
    row = np.repeat(row_of_text, size)
    row, text, pos, code = (x[~is_end] for x in (row, np.repeat(np.arange(len(size)), size), pos, code))
    _, same, times = np.unique(row * max(len(coded.dictionary), 1) + code, return_inverse=True, return_counts=True)
    # words of a sentence stand in a row
    begin = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(pos) != 0))) if len(pos) else np.zeros(0, int)
    n_words = np.diff(np.append(begin, len(pos)))
    mass = np.add.reduceat(times[same], begin) if len(begin) else np.zeros(0, int)
    # sentences of one key at the same place and of the same length are one
    order = np.lexsort((n_words, pos[begin], row[begin]))
    of, at, n, mass = row[begin][order], pos[begin][order], n_words[order], mass[order]
    lead = np.flatnonzero(np.append(True, (np.diff(of) != 0) | (np.diff(at) != 0) | (np.diff(n) != 0))) if len(of) else np.zeros(0, int)
    mass = np.add.reduceat(mass, lead) if len(lead) else mass
    of, at, n = of[lead], at[lead], n[lead]
    total = np.bincount(of, n, n_rows).astype(np.int64)[of]
    columns = [pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(mass, pa.int64()), pa.array(total, pa.int64())]
    offsets = pa.array(np.searchsorted(of, np.arange(n_rows + 1)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(_MASS.value_type)))


@F.arrow_udf(_SENTENCES)
def _masses(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        per_text = np.asarray(pc.list_value_length(texts.flatten()))
        per_row = np.asarray(pc.list_value_length(texts))
        upto = np.append(0, np.cumsum(per_text))[np.append(0, np.cumsum(per_row))]
        cuts = np.flatnonzero(np.diff(upto[:-1] // _MOST_WORDS)) + 1 if len(texts) else []
        bounds = [0, *cuts, len(texts)]
        done = [_some_masses(texts.slice(a, b - a)) for a, b in zip(bounds, bounds[1:])]
        yield pa.concat_arrays(done).cast(_MASS)


def _struct(**fields: Column) -> Column:
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def best_sentences(found: Column, min_length: int, max_length: int, min_words: int = MIN_SENTENCE_WORDS) -> Column:
    """``array<struct<pos, taken, n_words>>`` in order, of a key's sentences with their ``mass``.

    A sentence's score is the mean probability of its words in the whole text. The best are
    kept while they fit into ``max_length`` words, and one more, cut to fit, while the summary
    has fewer than ``min_length``; ``taken`` is how many words are.
    """
    long_enough = F.filter(found, lambda s: s["n_words"] >= min_words)

    def scored(s: Column) -> Column:
        score = F.round(s["mass"] / (s["n_words"] * s["text_words"]), PLACES)
        return _struct(worse=F.negative(score), pos=s["pos"], n_words=s["n_words"].cast("long"))

    # No more than these fit, however many there are.
    first = F.slice(F.array_sort(F.transform(long_enough, scored)), 1, max(max_length, 0) // max(min_words, 1) + 2)
    nothing = _struct(upto=F.lit(0).cast("long"), kept=F.array().cast(_KEPT))

    def add(so_far: Column, s: Column) -> Column:
        before, upto = so_far["upto"], so_far["upto"] + s["n_words"]
        taken = F.least(s["n_words"], F.lit(max_length) - before)
        one = _struct(pos=s["pos"], taken=taken, n_words=s["n_words"])
        fits = (upto <= max_length) | (before < min(min_length, max_length))
        kept = F.when(fits, F.concat(so_far["kept"], F.array(one))).otherwise(so_far["kept"])
        return _struct(upto=upto, kept=kept)

    return F.sort_array(F.aggregate(first, nothing, add, lambda x: x["kept"]))


def _first_words(sentence: Column, n: Column) -> Column:
    """The sentence up to its ``n``-th blank-separated part."""
    return F.array_join(F.slice(F.split(sentence, r"\s+"), F.lit(1), n), " ")


def summarize_extractive(
    texts: DataFrame,
    key: str = "id",
    text: str = "text",
    output: str = "summary",
    min_length: int = fv.SUMMARY_MIN_LENGTH,
    max_length: int = fv.SUMMARY_MAX_LENGTH,
) -> DataFrame:
    """``(key, output)`` for each text; "" where no sentence is long enough.

    ``key`` is unique. The texts are shuffled once, whole; scoring and picking stay in
    the row. A text is cut once, into words and the ends between its sentences, and what a
    task counts at once are the words of many texts.
    """
    cut = f"({WORD}|{SENTENCE_END})"
    placed = texts.select(F.col(key), F.struct(F.col(text).alias("text")).alias("__text")).repartition(key)
    of_key = placed.groupBy(key).agg(F.collect_list("__text").alias("__texts"))
    known = F.filter("__texts", lambda t: t["text"].isNotNull())
    tokens = F.transform(known, lambda t: F.regexp_extract_all(F.lower(t["text"]), F.lit(cut), F.lit(1)))
    kept = F.when(F.col(key).isNotNull(), best_sentences(F.col("__found"), min_length, max_length))

    def pick(cut: Column) -> Column:
        def one(kept: Column) -> Column:
            sentence = F.get(cut, kept["pos"])
            whole = kept["taken"] >= kept["n_words"]
            return F.when(whole, sentence).otherwise(_first_words(sentence, kept["taken"].cast("int")))

        return F.array_join(F.transform("__kept", one), ". ")

    return (
        of_key.withColumn("__found", _masses(tokens))
        .select(key, kept.alias("__kept"), F.explode("__texts.text").alias("__text"))
        .select(key, F.coalesce(let(sentences(F.col("__text")), pick), F.lit("")).alias(output))
    )
