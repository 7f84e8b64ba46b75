"""Token ids of documents in binary files, in ascending order of the document ids.

Documents are dealt by ranges of their id (then a hash of the text, so that one id cannot
fill a task) and sorted within tasks; a task encodes its texts, packs the ids by Simple-8b
and writes files of about ``file_ids`` ids. A file holds counts, document ids, ids per document,
the word offset of every block and the words; all little-endian. Rows of Spark name the files
that count; one small window over them gives the position of each file in the whole stream.

Defined results: a null or empty text has the end id alone; null document ids come first;
repeated rows are documents of their own; no rows give no files and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm import files, frames, simple8b, textcore
from newslens.llm.wordstore import WordStore, bounds, flattened, spread
from newslens.settings import shared_dir, stored

END_ID = 2
FILE_IDS = 1 << 22
KNOWN_WORDS = 500_000
SLICE_BYTES = 1 << 23
MAGIC = b"IDS-S8B1"
_HEAD = struct.Struct("<8s4Q")  # magic, documents, ids, blocks, words


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TextEncoder:
    """Ids of texts by a tokenizer file, each followed by ``end_id``.

    ``by_words``: encode distinct words once. Right for tokenizers that lower-case, whose pre-tokenizer
    drops white space and parts letters from punctuation, and whose tokens never reach over either.
    """

    def __init__(self, path: str, end_id: int, by_words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.by_words = Tokenizer.from_file(path), end_id, by_words
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.store = WordStore(self._words, KNOWN_WORDS)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words of Latin letters go many at a time: each ends with the only token that ends a word."""
        plain = np.array([w.isalpha() and (w.isascii() or max(w) <= "\u00ff") for w in words], bool)
        starts, lengths = np.zeros(len(words), np.int64), np.full(len(words), -1)
        parts, size, places = [], 0, np.flatnonzero(plain)
        for first in range(0, len(places), 4000):
            some = places[first : first + 4000]
            ids = np.array(self._whole([" ".join([words[k] for k in some.tolist()])])[0], np.int32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                starts[some] = size + np.concatenate([[0], ends[:-1]])
                lengths[some] = np.diff(ends, prepend=0)
                parts.append(ids)
                size += len(ids)
        rest = np.flatnonzero(lengths < 0)
        flat, own = flattened(self._whole([words[k] for k in rest.tolist()]))
        starts[rest], lengths[rest] = size + np.cumsum(own) - own, own
        return np.concatenate([*parts, flat])[spread(starts, lengths)], lengths

    def _parted(self, texts: pa.Array) -> pa.ListArray:
        """Texts cut where no token reaches over: at spaces, and between a letter and a stop or comma."""
        texts = pc.replace_substring(texts, "\n", " ")
        if not any(pc.any(pc.match_substring(texts, s, ignore_case=True)).as_py() for s in self.special):
            texts = pc.ascii_lower(texts)  # a special token in other letters would become one
        return pc.split_pattern(pc.replace_substring_regex(texts, "([A-Za-zÀ-ÖØ-öø-ÿ])([.,])", "\\1 \\2"), " ")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the bounds of rows."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words:
            found = self._whole(texts.to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(f) + 1 for f in found])])
            return np.array([i for f in found for i in (*f, self.end_id)], np.int64), ends
        self.store.trim()
        rows = self._parted(texts)
        number = self.store.numbers(rows.flatten(), True)
        count = self.store.lengths[number] if len(number) else np.zeros(0, np.int64)
        sums = np.concatenate([[0], np.cumsum(count)])[bounds(rows)]
        n = np.diff(sums)
        ends = sums + np.arange(len(sums))
        out = np.full(int(ends[-1]), self.end_id, np.int64)
        out[spread(ends[:-1], n)] = self.store.ids(number, count)
        return out, ends


@lru_cache(2)
def _encoder(path: str, end_id: int, by_words: bool) -> TextEncoder:
    return TextEncoder(path, end_id, by_words)


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The parts of a file."""
    words, offsets = simple8b.encode(ids.astype(np.uint64))
    known = np.array([i is not None for i in doc_ids], np.uint8)
    names = np.array([0 if i is None else i for i in doc_ids], "<i8")
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(offsets) - 1, len(words))
    return [head, names.tobytes(), known.tobytes(), counts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(),
            words.astype("<u8").tobytes()]


def unpack(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids per document, all ids."""
    magic, docs, n, blocks, words = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    at = _HEAD.size
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", blocks + 1), ("<u8", words)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    if at != len(data):
        raise ValueError("a file of token ids is cut short")
    names, known, counts, offsets, packed = parts
    doc_ids = [i if ok else None for i, ok in zip(names.tolist(), known.tolist(), strict=True)]
    return doc_ids, counts.astype(np.int64), simple8b.decode(packed.astype(np.uint64), offsets.astype(np.int64), n)


def write(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    by_words: bool = True,
    file_ids: int = FILE_IDS,
    folder: str | None = None,
) -> DataFrame:
    """Write the files; a row per file: part, number, path, n_docs, n_ids, start (ids before it)."""
    path = tokenizer or default_tokenizer()
    folder = folder or shared_dir(docs.sparkSession, "ids")
    rows = docs.select(F.col(frames.quoted(doc_id)).cast("long").alias("id"), F.col(frames.quoted(text)).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie")
    rows = rows.sortWithinPartitions("id", "tie").drop("tie")

    def save(batches):
        coder = _encoder(path, end_id, by_words)
        part, number = TaskContext.get().partitionId(), 0
        names, counts, ids = [], [], []

        def flush():
            nonlocal names, counts, ids, number
            flat, n = np.concatenate(ids), np.concatenate(counts)
            uri = files.write(folder, "s8b", pack(names, n, flat))
            row = [part, number, uri, len(names), len(flat)]
            names, counts, ids, number = [], [], [], number + 1
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                names=["part", "number", "path", "n_docs", "n_ids"],
            )

        for batch in batches:
            texts = batch.column("text")
            for first, end, _, _ in textcore.slices(texts, min(SLICE_BYTES, 4 * file_ids)):
                flat, ends = coder.encode(texts.slice(first, end - first))
                names += batch.column("id").slice(first, end - first).to_pylist()
                counts.append(np.diff(ends))
                ids.append(flat)
                if sum(map(len, ids)) >= file_ids:
                    yield flush()
        if names:
            yield flush()

    written = rows.mapInArrow(save, "part int, number int, path string, n_docs long, n_ids long")
    written = stored(written, "id-files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 and, unless left out, the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def load(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                doc_ids, counts, ids = unpack(files.read(path))
                ends = np.concatenate([[0], np.cumsum(counts)])
                little = ids.astype("<u4")
                crc = [zlib.crc32(little[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(ends[:-1] + start), pa.array(counts), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.dealt(manifest.select("path", "start")).mapInArrow(load, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return read(write(spark.read.parquet(f"{sf_dir}/documents.parquet")), with_ids=False)
