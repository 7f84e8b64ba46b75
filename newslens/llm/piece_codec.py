"""SentencePiece encoding by a batched Viterbi search, and decoding.

A text is cut at spaces and line feeds into words; a word that follows a space, or begins
the text, starts with the space mark. Distinct words of a batch that are not yet known are
grouped by length: all words of a length advance together, hashes of all their substrings
probe the sorted hashes of the pieces at once, and for every end the best sum of piece
scores and its backpointer are kept. Ties go to the longer piece. A character that is no piece
becomes its UTF-8 bytes, at a cost below every piece.

The pieces and scores come from a SentencePiece model file (a parameter); its merges are not
used: the result is the segmentation of highest score. Decoding restores every text exactly:
a literal space mark in a text is written as bytes, and no text is normalised.

Defined results: a null text has no ids (null), an empty one has an empty list; decoding them
gives null and the empty text. Ids outside the vocabulary decode to nothing. Known words are
kept per task, ``max_known`` at most, and dropped together beyond that.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, textcore
from newslens.llm.textcore import U64
from newslens.llm.wordstore import MAX_KNOWN, WordStore, bounds, spread

MARK = 0x2581  # stands for a space
_LITERAL = 0x110000  # a mark that stands in the text itself; beyond all code points
_CELLS = 1 << 21
SLICE_BYTES = 1 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _roll(code: np.ndarray) -> np.ndarray:
    """Prefix hashes along the last axis: one more than the characters."""
    out = np.zeros((*code.shape[:-1], code.shape[-1] + 1), U64)
    for i in range(code.shape[-1]):
        out[..., i + 1] = out[..., i] * U64(textcore._PRIME) + code[..., i].astype(U64) + U64(1)
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Code points of equally long words, one word a line."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), -1)


class Pieces:
    """The pieces of a model file: sorted hashes with ids and scores, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.byte_ids = np.full(256, model.unk_id(), np.int32)
        texts, ids, scores, self.longest = [], [], [], 1
        shown: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                shown.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                shown.append(b"")
            else:
                shown.append(piece.replace(chr(MARK), " ").encode())
                texts.append(piece)
                ids.append(i)
                scores.append(model.get_score(i))
                self.longest = max(self.longest, len(piece))
        self.parts_lines = not any("\n" in t and len(t) > 1 for t in texts)
        hashes = np.array([self.hash(t) for t in texts], U64)
        by = np.argsort(hashes)
        self.hashes, self.ids = hashes[by], np.array(ids, np.int32)[by]
        self.scores = np.array(scores, float)[by]
        self.unknown = (min(scores) if scores else 0.0) - 10.0
        self.lengths = np.array([len(b) for b in shown], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)

    @staticmethod
    def hash(text: str) -> int:
        value = 0
        for ch in text:
            value = (value * textcore._PRIME + ord(ch) + 1) % (1 << 64)
        return (value + len(text) * 0x632BE59BD9B4E019) % (1 << 64)

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score (minus infinity: no piece) and id of substrings by hash."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        return np.where(known, self.scores[at], -np.inf), np.where(known, self.ids[at], -1)

    def best(self, code: np.ndarray) -> list[np.ndarray]:
        """Ids of the best segmentation of equally long words (code points, one word a line)."""
        out: list[np.ndarray] = []
        step = max(1, _CELLS // max(1, code.shape[1] * self.longest))
        for first in range(0, len(code), step):
            out += self._best(code[first : first + step])
        return out

    def _best(self, code: np.ndarray) -> list[np.ndarray]:
        count, length = code.shape
        widest = min(self.longest, length)
        widths = np.arange(widest, 0, -1)  # longer pieces first: argmax keeps the first of equals
        prefix = _roll(code)
        total = np.full((count, widest + length), -np.inf)  # column widest + e: best sum up to e
        total[:, widest - 1 + 1] = 0.0
        piece = np.empty((count, length + 1), np.int32)
        back = np.empty((count, length + 1), np.int64)
        power = np.array([pow(textcore._PRIME, int(w), 1 << 64) for w in widths], U64)
        salt = np.array([int(w) * 0x632BE59BD9B4E019 % (1 << 64) for w in widths], U64)
        lines = np.arange(count)
        total = np.concatenate([total, np.full((count, 1), -np.inf)], 1)
        block = max(1, _CELLS // max(1, count * widest))
        for low in range(1, length + 1, block):
            ends = np.arange(low, min(low + block, length + 1))
            begin = ends[:, None] - widths  # (ends, widths)
            inside = begin >= 0
            hashes = prefix[:, ends][:, :, None] - prefix[:, np.maximum(begin, 0)] * power + salt
            score, ids = self.probe(hashes.reshape(-1))
            score = np.where(inside, score.reshape(hashes.shape), -np.inf)
            ids = ids.reshape(hashes.shape)
            unknown = score[:, :, -1] == -np.inf
            score[:, :, -1] = np.where(unknown, self.unknown, score[:, :, -1])
            for k, end in enumerate(ends.tolist()):
                sums = total[:, end : end + widest] + score[:, k]
                choice = sums.argmax(1)
                total[:, widest + end] = sums[lines, choice]
                back[:, end] = end - widths[choice]
                piece[:, end] = ids[lines, k, choice]
        return [self._walk(code[i], piece[i], back[i]) for i in range(count)]

    def _walk(self, code: np.ndarray, piece: np.ndarray, back: np.ndarray) -> np.ndarray:
        out, end = [], len(code)
        while end:
            begin = int(back[end])
            if piece[end] >= 0:
                out.append([int(piece[end])])
            else:
                cp = MARK if code[begin] == _LITERAL else int(code[begin])
                out.append(self.byte_ids[list(chr(cp).encode("utf-8", "surrogatepass"))].tolist())
            end = begin
        return np.array([i for part in reversed(out) for i in part], np.int32)


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Coder:
    """Encodes batches of texts; remembers the ids of words."""

    def __init__(self, model: Pieces, max_known: int = MAX_KNOWN):
        self.model = model
        self.store = WordStore(self._best, max_known)

    def _best(self, words: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        for length, places in by_length.items():
            code = np.full((len(places), length + marked), MARK, np.uint32)
            if length:
                own = _codes([words[k] for k in places])
                code[:, int(marked) :] = np.where(own == MARK, _LITERAL, own)
            if code.shape[1]:
                for k, ids in zip(places, self.model.best(code), strict=True):
                    found[k] = ids
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the bounds of rows. Null counts as empty."""
        self.store.trim()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        rows = pc.split_pattern(texts, " ")
        words, word_bounds = rows.flatten(), bounds(rows)
        if self.model.parts_lines:
            # a line feed is one byte piece, and what follows it has no space mark
            parts = pc.split_pattern(words, "\n")
            part_bounds, words = bounds(parts), parts.flatten()
            feeds = np.ones(len(words), bool)
            feeds[part_bounds[:-1]] = False
            word_bounds = part_bounds[word_bounds]
        else:
            feeds = np.zeros(len(words), bool)
        number = np.empty(len(words), np.int64)
        number[~feeds] = self.store.numbers(words.filter(pa.array(~feeds)), True)
        if feeds.any():
            number[feeds] = self.store.numbers(words.filter(pa.array(feeds)), False)
        count = self.store.lengths[number]
        empty = np.diff(textcore.buffers(texts)[1]) == 0
        count[word_bounds[:-1][empty]] = 0  # an empty text has not even the mark
        total = np.concatenate([[0], np.cumsum(count + feeds)])
        out = np.empty(total[-1], np.int32)
        out[total[:-1][feeds]] = self.model.byte_ids[10]
        out[spread(total[:-1] + feeds, count)] = self.store.ids(number, count)
        return out, total[word_bounds]


def decode(model: Pieces, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and their bounds; the mark that begins a text is left out."""
    ids = np.where((ids >= 0) & (ids < len(model.lengths)), ids, 0)
    count = model.lengths[ids]
    total = np.concatenate([[0], np.cumsum(count)])
    data = model.bytes[np.repeat(model.starts[ids] - total[:-1], count) + np.arange(total[-1])]
    rows = total[ends]
    lead = np.flatnonzero((np.diff(rows) > 0))
    lead = lead[data[rows[lead]] == 0x20]
    keep = np.ones(len(data), bool)
    keep[rows[lead]] = False
    dropped = np.zeros(len(rows), np.int64)
    dropped[lead + 1] = 1
    return data[keep], rows - np.cumsum(dropped)


def worked(batches, model: Pieces, kept: list[str], names: list[str], work):
    """Record batches of ``kept`` and what ``work`` adds, of about ``SLICE_BYTES`` of text each; a text is never cut."""
    coder = Coder(model)
    for batch in batches:
        for first, end, _, _ in textcore.slices(batch.column("text"), SLICE_BYTES):
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + work(model, coder, part.column("text")), names=names)


def _mapped(packed: DataFrame, path: str, kept: list[str], added: str, work) -> DataFrame:
    schema = T.StructType([*[packed.schema[c] for c in kept], *T.StructType.fromDDL(added).fields])
    names = schema.names

    def run(batches):
        yield from worked(batches, pieces(path), kept, names, work)

    return packed.mapInArrow(run, schema)


def _ids(model: Pieces, coder: Coder, texts) -> list[pa.Array]:
    flat, ends = coder.encode(texts)
    return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=texts.is_null())]


def _digest(model: Pieces, coder: Coder, texts) -> list[pa.Array]:
    n, crc, same = [], [], []
    flat, at = coder.encode(texts)
    raw, offsets = textcore.buffers(texts)
    back, ends = decode(model, flat, at)
    little = flat.astype("<u4")
    for i in range(len(texts)):
        n.append(int(at[i + 1] - at[i]))
        crc.append(zlib.crc32(little[at[i] : at[i + 1]]))
        same.append(bool(np.array_equal(back[ends[i] : ends[i + 1]], raw[offsets[i] : offsets[i + 1]])))
    return [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]


def encode(docs: DataFrame, *, model: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns with the ids of each text; a column of that name is replaced."""
    found = _mapped(frames.pack(docs, text), model or default_model(), ["row", "text"], "ids array<int>", _ids)
    return frames.unpack(found, text, docs.columns, **{ids: F.col("ids")})


def decoded(rows: DataFrame, *, model: str | None = None, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns with the text of each list of ids; a column of that name is replaced."""
    path = model or default_model()
    packed = rows.select(F.struct(*[F.col(frames.quoted(c)) for c in rows.columns]).alias("row"), F.col(ids).alias("ids"))
    schema = T.StructType([packed.schema["row"], T.StructField("decoded", T.StringType())])

    def run(batches):
        own = pieces(path)
        for batch in batches:
            texts = []
            for value in batch.column("ids").to_pylist():
                flat = np.array([i for i in value or [] if i is not None], np.int64)
                raw, _ = decode(own, flat, np.array([0, len(flat)]))
                texts.append(None if value is None else raw.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=schema.names)

    found = packed.mapInArrow(run, schema)
    return found.select(*[F.col("row")[c].alias(c) for c in rows.columns if c != text], F.col("decoded").alias(text))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    added = "n_tokens long, ids_crc32 long, round_trip boolean"
    found = _mapped(frames.pack(docs, "text", ["doc_id"]), default_model(), ["row"], added, _digest)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_crc32", "round_trip")
