"""Sentence ends learned from the texts: words that are mostly followed by a period are
abbreviations (the type-based score of Kiss and Strunk 2006), and end no sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.columns import let
from newslens.operators.skew import lookup_join

DOTTED = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"
PART_END = r"(?<=[.!?])(?=\s)"
ALWAYS = 0.99  # how often an abbreviation is followed by its period
THRESHOLD = 0.3
PLACES = 6


def count_periods(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, n_period)``: how often each lower-case word occurs and how often a period
    follows. Inner periods belong to the word. Counts combine before their shuffle."""
    tokens = texts.select(
        F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"({DOTTED}\.?)"), F.lit(1))).alias("t")
    )
    period = F.endswith("t", F.lit("."))
    return tokens.groupBy(F.rtrim("t", F.lit(".")).alias("word")).agg(
        F.count("*").alias("n"), F.count_if(period).alias("n_period")
    )


def abbreviations(counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The words of :func:`count_periods` that are abbreviations, with their ``score``.

    The log-likelihood ratio of "a period nearly always follows" against "as often as
    after any word", lowered by the word's length and by every time no period followed,
    raised by inner periods. Only words with a letter that a period followed at least
    once are asked. ``counts`` is read twice.
    """
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_period").alias("p")).first()
    share = (total["p"] or 0) / (total["n"] or 1)
    if not 0 < share < 1:  # no period, or nothing but: no word stands out
        return counts.where(F.lit(False)).withColumn("score", F.lit(0.0))
    k, rest = F.col("n_period").cast("double"), (F.col("n") - F.col("n_period")).cast("double")
    ratio = 2 * (
        k * (F.log(F.lit(ALWAYS)) - F.log(F.lit(share)))
        + rest * (F.log(F.lit(1 - ALWAYS)) - F.log(F.lit(1 - share)))
    )
    letters = F.length(F.replace("word", F.lit("."))).cast("double")
    inner = F.length("word") - letters + 1
    score = ratio * F.exp(-letters) * inner * F.pow(letters, -rest)
    asked = counts.where((F.col("n_period") > 0) & F.col("word").rlike(r"\p{L}"))
    return asked.withColumn("score", F.round(score, PLACES)).where(F.col("score") >= threshold)


def split_sentences(texts: DataFrame, known: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """``(key, pos, sentence)``: texts cut after ``.``, ``!`` or ``?`` before white space, but
    not after a word of ``known``.

    Marks stay with their sentence, white space around it goes, empty sentences are left
    out; null texts have none. ``key`` is unique. Only (key, position, last word) meet the
    abbreviations; a word that ends very many parts is split over tasks. The text itself is
    shuffled once, whole.
    """
    parts = F.split(F.col(text), PART_END)
    last = F.regexp_extract(F.lower(F.col("part")), rf"({DOTTED})\.$", 1)
    ends = (
        texts.select(F.col(key), F.posexplode(parts).alias("at", "part"))
        .select(key, "at", last.alias("word"))
        .where(F.col("word") != "")
    )
    open_ends = (
        lookup_join(ends, known.select("word"), ["word"], [key, "at"], "inner")
        .groupBy(key)
        .agg(F.collect_set("at").alias("__open"))
    )

    def join_parts(ps: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ps) - 1)
        nothing = F.array().cast("array<int>")
        closed = F.array_except(places, F.coalesce("__open", nothing))
        closed = F.array_union(closed, F.array(F.size(ps) - 1))
        return let(closed, lambda stops: F.transform(stops, lambda stop, i: cut(ps, stops, stop, i)))

    def cut(ps: Column, stops: Column, stop: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(stops, i - 1) + 1)
        return F.regexp_replace(F.array_join(F.slice(ps, start + 1, stop - start + 1), ""), r"^\s+|\s+$", "")

    joined = texts.where(F.col(text).isNotNull()).select(key, F.col(text)).join(open_ends, key, "left")
    whole = F.filter(let(parts, join_parts), lambda s: s != "")
    return joined.select(key, F.posexplode(whole).alias("pos", "sentence"))
