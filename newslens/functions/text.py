"""Characters, words and sentences as array Columns. No shuffles, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.columns import let, running_starts

WORD = r"[\p{L}\p{N}]+"
PIECE = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"
SENTENCE_END = r"[.!?]\s+"


def char_ngrams(name: Column, n: int = fv.NGRAM_SIZE) -> Column:
    """Overlapping lower-case character n-grams, spaces included.

    Empty for names shorter than ``n``: ``sequence`` would count downwards.
    """
    return let(
        F.lower(name),
        lambda s: F.when(
            F.length(s) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda p: F.substring(s, p, n)
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def words(text: Column) -> Column:
    """Lower-case words (letters and digits) in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def sentences(text: Column) -> Column:
    """Sentences in order; the end mark stays with the last one only."""
    return F.split(text, SENTENCE_END)


def pieces(text: Column) -> Column:
    """The text cut into alternating words and gaps; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(1))


def word_runs(text: Column, sizes: list[int]) -> Column:
    """Runs of ``size`` neighbouring words for each size, as
    ``array<struct<gram, start, end>>``.

    ``gram`` is the lower-case words joined by one blank, whatever was between
    them; ``start`` and ``end`` are 0-based positions in the text, both inclusive.
    """
    empty = F.array().cast("array<struct<gram:string,start:int,end:int>>")

    def runs_of(placed: Column, n: int) -> Column:
        ws, starts = placed["words"], placed["starts"]

        def run(word: Column, i: Column) -> Column:
            in_run = [word, *[x for j in range(1, n) for x in (F.lit(" "), F.get(ws, i + j))]]
            last = word if n == 1 else F.get(ws, i + (n - 1))
            return F.struct(
                F.lower(F.concat(*in_run) if n > 1 else word).alias("gram"),
                F.get(starts, i).alias("start"),
                (F.get(starts, i + (n - 1)) + F.length(last) - 1).alias("end"),
            )

        heads = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(0)))
        return F.when(F.size(ws) >= n, F.transform(heads, run)).otherwise(empty)

    def place(ps: Column) -> Column:
        first = F.when(F.get(ps, F.lit(0)).rlike(rf"^{WORD}"), 0).otherwise(1)
        starts = running_starts(F.transform(ps, lambda p: F.length(p)))
        return F.struct(
            let(first, lambda f: F.filter(ps, lambda _, i: i % 2 == f)).alias("words"),
            let(first, lambda f: F.filter(starts, lambda _, i: i % 2 == f)).alias("starts"),
        )

    return let(let(pieces(text), place), lambda x: F.concat(*[runs_of(x, n) for n in sizes]))
