"""A trained tagger of organisations: a structured perceptron over word features with Viterbi decoding.

Training is iterative parameter mixing: in every round each partition runs one epoch of perceptron updates from the
same weights, Spark sums the changes, and the mean over partitions is the next round's start. The model is the mean over
rounds. Features are hashed to ``2 ** bits`` rows of three numbers, so weights, changes and what reaches the driver
have that bound whatever the table's size. Labels are spans, for instance those of
:func:`newslens.operators.entities.extract_entities`.

Tags are outside, begin and inside; inside never follows outside. A sequence ends after ``.``, ``!`` or ``?``. A NULL or
empty text has no spans; rows with a NULL text or NULL spans teach nothing; ties go to the tag named first. Sequences
are told by their words alone, so a name that was never seen is found by its shape, its endings and its neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.operators.gazetteer import SPANS, slices
from newslens.settings import stored

OUTSIDE, BEGIN, INSIDE = range(3)
START = 3  # row of the transitions before the first word
BITS = 18
ROUNDS = 5
SEQUENCES = 16  # decoded with the same weights before an update
_TOKEN = re.compile(r"\w+|[^\w\s]")
_NEVER = -1e9
NARROW = 4  # so many sequences are decoded one after the other
SLICE_BYTES = 1 << 20  # of texts that are read at once
_MOST_GROUPS = 256  # of SEQUENCES, decoded before an update
_PARTS = 4  # own word, shape, ending, beginning
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _shape(word: str) -> str:
    kinds = "".join("X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else c for c in word[:8])
    return re.sub(r"(.)\1+", r"\1", kinds)


@lru_cache(1 << 17)
def _parts(word: str) -> tuple[int, ...]:
    low = word.lower()
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) for p in (f"w{low}", f"s{_shape(word)}", f"e{low[-3:]}", f"b{low[:3]}"))


@lru_cache(1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point, as ``_TOKEN`` sees it: whether words have it, and whether it is a blank."""
    points = [chr(i) for i in range(0x110000)]
    word = np.fromiter((c == "_" or c.isalnum() for c in points), bool, len(points))
    return word, np.fromiter((c.isspace() for c in points), bool, len(points))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Of all words of some texts: text number, first code point and the one after the last in the text, and the word."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # the first byte of each code point
    bounds = np.searchsorted(at, offsets - offsets[0])
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    word, blank = (kind[points] for kind in _kinds())
    cut = np.zeros(len(points) + 1, bool)
    cut[bounds] = True
    inside = np.concatenate([[False], word, [False]])
    alone = ~word & ~blank
    starts = np.flatnonzero(alone | word & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(alone | word & (~inside[2:] | cut[1:])) + 1
    # words and what lies between them, of which every second is a word
    places = np.column_stack([at[starts], at[ends]]).ravel() if len(starts) else np.zeros(1, np.int64)
    strings = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw))
    words = strings.take(pa.array(np.arange(0, len(strings), 2))).dictionary_encode()
    row = np.searchsorted(bounds, starts, "right") - 1
    return row, starts - bounds[row], ends - bounds[row], words


def _tags(row: np.ndarray, begin: np.ndarray, end: np.ndarray, spans: list[list[dict] | None]) -> np.ndarray:
    """The tags of words, which stand in order, by the spans of their texts."""
    tags = np.full(len(row), OUTSIDE, np.int64)
    first = np.searchsorted(row, np.arange(len(spans) + 1))
    for i, found in enumerate(spans):
        if found:
            own = np.array(sorted((s["start"], s["end"]) for s in found))
            a, b = begin[first[i] : first[i + 1]], end[first[i] : first[i + 1]]
            at = np.searchsorted(np.maximum.accumulate(own[:, 1]), a)  # the first span that doesn't end before the word
            lo, hi = own[np.minimum(at, len(own) - 1)].T
            inside = (at < len(own)) & (lo <= a) & (b <= hi)
            tags[first[i] : first[i + 1]][inside] = np.where(lo == a, BEGIN, INSIDE)[inside]
    return tags


def read(texts: pa.Array | list[str | None], spans: list[list[dict] | None] | None = None):
    """Of all words of some texts: text number, first and last code point, hashed parts, tags, and bounds of sequences."""
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
    row, begin, end, words = _tokens(texts)
    end = end - 1
    tags = _tags(row, begin, end, spans) if spans else np.full(len(row), OUTSIDE, np.int64)
    named = words.dictionary.to_pylist()
    code = np.asarray(words.indices).astype(np.int64)
    hashed = np.array([_parts(w) for w in named], np.uint64).reshape(-1, _PARTS)[code]
    stops = np.fromiter((w in ".!?" for w in named), bool, len(named))[code]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    return row, begin, end, hashed, tags, np.append(0, np.flatnonzero(stops | last) + 1)


def features(parts: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Rows of the weights for each word: its own parts, those of its neighbours, and shapes side by side."""
    n = len(parts)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    before, after = np.roll(parts, 1, 0), np.roll(parts, -1, 0)
    before[first], after[last] = 1, 2
    shapes = [p[:, 1] for p in (before, parts, after)]
    pairs = [shapes[0] * np.uint64(31) + shapes[1], shapes[1] * np.uint64(37) + shapes[2]]
    columns = [np.full(n, 7, np.uint64), *parts.T, *before.T[:3], *after.T[:3], *pairs]
    out = np.empty((n, len(columns)), np.int64, order="F")
    for k, column in enumerate(columns):
        mixed = (column + np.uint64(k * 0x632BE59BD9B4E019 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = mixed >> np.uint64(64 - bits)
    return out


def _decode_on(emission: np.ndarray, places: np.ndarray, allowed: np.ndarray, score: list[float] | None, found: np.ndarray) -> int:
    """One sequence from ``places`` on, whose tags go to ``found``, by plain numbers: a call on arrays for each word
    takes longer. ``score`` is that of the word before, None at the start; its tag is returned."""
    (a, b, c), (d, e, f), (g, h, i), start = allowed.tolist()
    rows, back = emission.take(places - places[0], 0).tolist(), []
    if score is None:
        score, back = [x + y for x, y in zip(rows[0], start)], [(0, 0, 0)]
    x, y, z = score
    for p, q, r in rows[len(back) :]:
        u, v, w, of_u, of_v, of_w = x + a, x + b, x + c, 0, 0, 0
        if y + d > u:
            u, of_u = y + d, 1
        if z + g > u:
            u, of_u = z + g, 2
        if y + e > v:
            v, of_v = y + e, 1
        if z + h > v:
            v, of_v = z + h, 2
        if y + f > w:
            w, of_w = y + f, 1
        if z + i > w:
            w, of_w = z + i, 2
        x, y, z = u + p, v + q, w + r
        back.append((of_u, of_v, of_w))
    tag = 0 if x >= y and x >= z else 1 if y >= z else 2
    tags = []
    for step in reversed(back):
        tags.append(tag)
        tag = step[tag]
    found[places] = tags[::-1]
    return tag


def decode(emission: np.ndarray, transition: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best tags of all sequences: Viterbi search, all sequences one word further at a time."""
    allowed = transition.copy()
    allowed[[OUTSIDE, START], INSIDE] = _NEVER
    length = np.diff(bounds)
    by = np.argsort(-length, kind="stable")
    starts, length = bounds[:-1][by], length[by]
    score = np.zeros((len(by), 3))
    back, found = np.zeros((len(emission), 3), np.int8), np.zeros(len(emission), np.int64)
    longest = int(length[0]) if len(length) else 0
    going = np.searchsorted(-length, -np.arange(longest), "left")  # sequences longer than so many words
    # Words that stand at the same place of their sequences lie side by side.
    first = np.append(0, np.cumsum(going))
    place = np.arange(first[-1]) - np.repeat(first[:-1], going)
    words = starts[place] + np.repeat(np.arange(longest), going)
    emission = emission[words]
    wide = int(np.searchsorted(-going, -NARROW, "left"))  # places of more sequences than NARROW
    for t, (a, b) in enumerate(zip(first[:wide].tolist(), first[1 : wide + 1].tolist())):
        if t == 0:
            score[: b - a] = emission[a:b] + allowed[START]
            continue
        ways = score[: b - a, :, None] + allowed[None, :START]
        back[a:b] = ways.argmax(1)
        score[: b - a] = ways.max(1) + emission[a:b]
    tag, line = score.argmax(1), np.arange(len(by))
    for k in range(int(going[wide]) if wide < longest else 0):
        places = first[wide : np.searchsorted(-going, -k, "left")] + k
        tag[k] = _decode_on(emission[places[0] :], places, allowed, score[k].tolist() if wide else None, found)
    for a, b in zip(first[:wide][::-1].tolist(), first[1 : wide + 1][::-1].tolist()):
        found[a:b] = tag[: b - a]
        tag[: b - a] = back[a:b][line[: b - a], tag[: b - a]]
    tags = np.zeros(len(emission), np.int64)
    tags[words] = found
    return tags


def _before(tags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.roll(tags, 1)
    out[bounds[:-1][np.diff(bounds) > 0]] = START
    return out


def _emission(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the weights of each word's features."""
    out = weights.take(rows[:, 0], 0)
    for k in range(1, rows.shape[1]):
        out += weights.take(rows[:, k], 0)
    return out


def epoch(weights: np.ndarray, parts: np.ndarray, gold: np.ndarray, bounds: np.ndarray, bits: int) -> None:
    """Perceptron updates in place; the last four rows of the weights are the transitions.

    The weights change after a group of ``SEQUENCES`` with a wrong tag. Many groups are decoded with the same weights:
    those up to the first wrong one would be decoded alike one by one, those after it are decoded anew."""
    rows, cells = features(parts, bounds, bits), weights.reshape(-1)
    k, groups = 0, 1
    while k < len(bounds) - 1:
        own = bounds[k : k + groups * SEQUENCES + 1]
        a, b = own[0], own[-1]
        got = decode(_emission(weights, rows[a:b]), weights[-4:], own - a)
        wrong = got != gold[a:b]
        if not wrong.any():
            k, groups = k + groups * SEQUENCES, min(2 * groups, _MOST_GROUPS)
            continue
        right = (int(np.searchsorted(own - a, wrong.argmax(), "right")) - 1) // SEQUENCES  # groups before the wrong one
        own = own[right * SEQUENCES :][: SEQUENCES + 1]
        some, want, got, cut = rows[own[0] : own[-1]], gold[own[0] : own[-1]], got[own[0] - a : own[-1] - a], own - own[0]
        for tags, step in ((want, 1.0), (got, -1.0)):
            np.add.at(cells, (some * 3 + tags[:, None]).ravel(), step)
            np.add.at(cells, (len(weights) - 4 + _before(tags, cut)) * 3 + tags, step)
        k, groups = k + (right + 1) * SEQUENCES, right + 1


def _taught(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts, tags and bounds of the words of a batch, a slice of texts at a time; only the last one's number of
    sequences may be no multiple of ``SEQUENCES``."""
    left = np.zeros((0, _PARTS), np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    done = 0
    for texts in slices(batch.column("text"), SLICE_BYTES):
        _, _, _, parts, gold, bounds = read(texts, batch.column("spans").slice(done, len(texts)).to_pylist())
        done += len(texts)
        parts, gold = np.concatenate([left[0], parts]), np.concatenate([left[1], gold])
        bounds = np.concatenate([left[2], bounds[1:] + len(left[1])])
        whole = (len(bounds) - 1) // SEQUENCES * SEQUENCES
        yield parts[: bounds[whole]], gold[: bounds[whole]], bounds[: whole + 1]
        left = parts[bounds[whole] :], gold[bounds[whole] :], bounds[whole:] - bounds[whole]
    yield left


def train(rows: DataFrame, text: str, spans: str, *, rounds: int = ROUNDS, bits: int = BITS) -> np.ndarray:
    """Weights of features and transitions, ``2 ** bits + 4`` rows of three, learned from all rows with spans."""
    spark = rows.sparkSession
    own = F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    table = rows.select(F.col(text).alias("text"), own.alias("spans")).where("text is not null and spans is not null")
    table = stored(table.repartition("text"), "tagged")  # every partition learns from about as much
    weights, total = np.zeros((2**bits + 4, 3)), np.zeros((2**bits + 4, 3))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(weights)  # three numbers for each of 2 ** bits rows

        def learn(batches: Iterator[pa.RecordBatch], sent=sent):
            own = None
            for batch in batches:
                for parts, gold, bounds in _taught(batch):
                    if len(gold):
                        own = sent.value.copy() if own is None else own
                        epoch(own, parts, gold, bounds, bits)
            if own is not None:
                change = (own - sent.value).ravel()
                at = np.append(np.flatnonzero(change), -1)  # -1 counts the partitions
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(change[at[:-1]], 1.0))], names=["at", "change"])

        summed = table.mapInArrow(learn, "at long, change double").groupBy("at").agg(F.sum("change").alias("change")).toArrow()
        at, change = summed.column("at").to_numpy(), summed.column("change").to_numpy()
        sent.unpersist()
        weights = weights.copy()
        if len(at):
            weights.reshape(-1)[at[at >= 0]] += change[at >= 0] / change[at < 0][0]
        total += weights
    return total / max(rounds, 1)


def tagged_spans(texts: pa.Array, weights: np.ndarray) -> pa.Array:
    """``(start, end)`` of the organisations in each text, 0-based code points, both inclusive."""
    return pa.concat_arrays([_tagged(part, weights) for part in slices(texts, SLICE_BYTES)]) if len(texts) else pa.array([], _ARROW)


def _tagged(texts: pa.Array, weights: np.ndarray) -> pa.Array:
    bits = (len(weights) - 4).bit_length() - 1
    row, begin, end, parts, _, bounds = read(texts)
    tags = decode(_emission(weights, features(parts, bounds, bits)), weights[-4:], bounds)
    first = np.flatnonzero(tags == BEGIN)
    nothing = np.flatnonzero(np.append(tags != INSIDE, True))  # a span ends before the next word that isn't inside
    last = nothing[np.searchsorted(nothing, first, "right")] - 1
    offsets = np.searchsorted(row[first], np.arange(len(texts) + 1))
    values = [pa.array(v.astype(np.int32)) for v in (begin[first], end[last])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(values, ["start", "end"])).cast(_ARROW)


def organisations(df: DataFrame, weights: np.ndarray, text: str) -> Column:
    """The spans of a text column of ``df`` by a trained tagger, as an Arrow function."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        return tagged_spans(texts, sent.value)

    return find(F.col(text))
