"""Summaries by beam search over sets of sentences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import fixed_values as fv
from newslens.functions.text import sentences, words
from newslens.operators.summaries import MIN_SENTENCE_WORDS

PLACES = 9


def coverage_score(mass, total, length, penalty: float):
    """``ln(share of the text's word mass covered) / length ** penalty``, at most 0.

    As with the log-probabilities of a generated text, a penalty above 0 favours long
    summaries: their negative score is divided by more.
    """
    return np.round(np.log(mass / total) / np.power(np.asarray(length, float), penalty), PLACES)


def search(
    codes: np.ndarray,
    starts: np.ndarray,
    min_length: int,
    max_length: int,
    beams: int,
    penalty: float,
    min_words: int = MIN_SENTENCE_WORDS,
) -> tuple[list[int], int]:
    """The sentences of the summary, in order, and one more to be cut (-1: none).

    ``codes`` numbers the words of a text, ``starts`` its sentences' bounds in them. A
    step adds one sentence to each kept set; the ``beams`` best distinct sets of a size
    go on. The best set of ``min_length`` to ``max_length`` words wins, ties to the
    smallest positions. If the search meets none, the best set of all is kept with the
    best sentence still left, to be cut to fit.
    """
    lengths = np.diff(starts)
    usable = lengths >= min_words
    if not usable.any():
        return [], -1
    _, word, count = np.unique(codes, return_inverse=True, return_counts=True)
    n, total = len(lengths), len(codes)
    sentence = np.repeat(np.arange(n), lengths)
    pairs = np.unique(sentence * np.int64(len(count)) + word.reshape(-1))
    of_sentence, of_word = pairs // len(count), pairs % len(count)

    def gains(covered: np.ndarray) -> np.ndarray:
        return np.bincount(of_sentence, np.where(covered, 0, count)[of_word], n)

    def add(covered: np.ndarray, i: int) -> np.ndarray:
        low, high = np.searchsorted(of_sentence, [i, i + 1])
        covered = covered.copy()
        covered[of_word[low:high]] = True
        return covered

    kept = [((), 0, 0, np.zeros(len(count), bool))]  # positions, words, mass, covered words
    finished, partial = [], []
    while kept:
        grown: dict[tuple[int, ...], tuple] = {}
        for chosen, length, mass, covered in kept:
            fits = usable & (length + lengths <= max_length)
            fits[list(chosen)] = False
            at = np.flatnonzero(fits)
            new_mass = mass + gains(covered)[at]
            scores = coverage_score(new_mass, total, length + lengths[at], penalty)
            # Of one parent's children no more than these can be among the best sets.
            if len(at) > beams:
                worst = np.partition(-scores, beams - 1)[beams - 1]
                near = np.flatnonzero(-scores <= worst)
                at, new_mass, scores = at[near], new_mass[near], scores[near]
            for i, m, s in zip(at.tolist(), new_mass.tolist(), scores.tolist(), strict=True):
                key = tuple(sorted((*chosen, i)))
                grown[key] = (-s, key, length + int(lengths[i]), m, covered, i)
        best = sorted(grown.values(), key=lambda c: c[:2])[:beams]
        for score, key, length, _, _, _ in best:
            (finished if length >= min_length else partial).append((score, key))
        kept = [(key, length, mass, add(covered, i)) for _, key, length, mass, covered, i in best]
    if finished:
        return list(min(finished)[1]), -1
    chosen = min(partial)[1] if partial else ()
    covered = np.zeros(len(count), bool)
    for i in chosen:
        covered = add(covered, i)
    left = usable.copy()
    left[list(chosen)] = False
    if not left.any():
        return list(chosen), -1
    return list(chosen), int(np.argmax(np.where(left, gains(covered) / np.maximum(lengths, 1), -1.0)))


def compose(cut: list[str], chosen: list[int], extra: int, room: int) -> str:
    """The chosen sentences in order; of ``extra`` the first ``room`` parts."""
    texts = {i: cut[i] for i in chosen}
    if extra >= 0 and room > 0:
        texts[extra] = " ".join(cut[extra].split()[:room])
    return ". ".join(texts[i] for i in sorted(texts))


def summarize_beams(
    texts: DataFrame,
    key: str = "id",
    text: str = "text",
    output: str = "summary",
    min_length: int = fv.SUMMARY_MIN_LENGTH,
    max_length: int = fv.SUMMARY_MAX_LENGTH,
    beams: int = fv.SUMMARY_BEAMS,
    penalty: float = fv.SUMMARY_LENGTH_PENALTY,
) -> DataFrame:
    """``(key, output)`` for each text; "" for null and where no sentence is long enough.

    Sentences and words are cut by Spark; the search sees one text at a time in Arrow
    batches. Nothing is shuffled, and equal keys are kept as they are.
    """
    cut = texts.select(F.col(key), F.coalesce(sentences(F.col(text)), F.array().cast("array<string>")).alias("cut"))
    cut = cut.withColumn("words", F.transform("cut", words))
    schema = T.StructType([cut.schema[key], T.StructField(output, T.StringType())])

    def summarize(batches):
        for batch in batches:
            listed = batch.column("words")
            bounds = listed.offsets.to_numpy()
            inner = listed.values
            starts = inner.offsets.to_numpy()
            codes = inner.values.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            out = []
            for row in range(batch.num_rows):
                own = starts[bounds[row] : bounds[row + 1] + 1].astype(np.int64)
                chosen, extra = [], -1
                if len(own) > 1:
                    chosen, extra = search(
                        codes[own[0] : own[-1]], own - own[0], min_length, max_length, beams, penalty
                    )
                room = max_length - int(sum(own[i + 1] - own[i] for i in chosen))
                out.append(compose(batch.column("cut")[row].as_py(), chosen, extra, room))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.string())], names=[key, output])

    return cut.mapInArrow(summarize, schema)
