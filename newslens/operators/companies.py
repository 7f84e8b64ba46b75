"""Which company an article is about."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.strings import has_corp_suffix, partial_levenshtein, partial_ratio
from newslens.operators.entities import extract_entities, organisations
from newslens.operators.skew import lookup_join

TEXT_COLUMNS = ("headline", "description", "summary")


def best_levenshtein(topic: Column, orgs: Column) -> Column:
    return F.array_max(F.transform(orgs, lambda o: partial_levenshtein(topic, o)))


def pair_ratios(pairs: DataFrame) -> DataFrame:
    """``pairs(topic, org)`` to each distinct pair with its partial ratio, ``score``.

    Articles repeat a few topics and names: a pair is scored in Python once, whatever
    the number of articles that have it. Pairs are placed by topic and name together,
    so those of a frequent topic lie in many tasks.
    """
    return pairs.distinct().withColumn("score", partial_ratio("topic", "org"))


def with_best_ratio(articles: DataFrame, key: str = "id") -> DataFrame:
    """Add ``similarity``, the highest partial ratio of ``topic`` with any of ``orgs``.

    ``key`` is unique. Texts stay where they are: only keys and pairs are exploded. A
    pair that many articles share is split over tasks when scores are joined back.
    """
    pairs = articles.select(key, "topic", F.explode(F.array_distinct("orgs")).alias("org"))
    scored = pair_ratios(pairs.select("topic", "org"))
    best = (
        lookup_join(pairs, scored, ["topic", "org"], [key], "inner")
        .groupBy(key)
        .agg(F.max("score").alias("similarity"))
    )
    return articles.join(best, key, "left")


def resolve_company(
    articles: DataFrame,
    threshold: int = fv.COMPANY_SIMILARITY_THRESHOLD,
    similarity: Callable[[Column, Column], Column] | None = None,
    strict_suffix: bool = False,
    key: str = "id",
) -> DataFrame:
    """``articles(id, topic, orgs)`` to the same with ``similarity`` and ``corp``.

    ``corp`` is the topic when some organisation resembles it more than the
    threshold or its name looks like a company, else "". An article with no
    organisations, or NULL ones, has similarity 0. By default the similarity is the
    partial ratio, scored once per distinct pair; a function of the topic and the
    array takes its place, for one row in, one row out and no shuffle.
    """
    if similarity is None:
        scored = with_best_ratio(articles, key)
    else:
        scored = articles.withColumn("similarity", similarity(F.col("topic"), F.col("orgs")))
    scored = scored.withColumn("similarity", F.coalesce("similarity", F.lit(0)))
    is_company = (F.col("similarity") > threshold) | has_corp_suffix(F.col("topic"), strict_suffix)
    return scored.withColumn("corp", F.when(is_company, F.col("topic")).otherwise(F.lit("")))


def find_organisations(
    articles: DataFrame, names: DataFrame, columns: tuple[str, ...] = TEXT_COLUMNS
) -> DataFrame:
    """Add an ``<column>_entities`` array per text column and ``orgs`` over all."""
    tagged = extract_entities(articles, names, {c: f"{c}_entities" for c in columns})
    return tagged.withColumn("orgs", organisations(*[F.col(f"{c}_entities") for c in columns]))
