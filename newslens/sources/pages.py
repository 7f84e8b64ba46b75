"""Article pages with JSON-LD to typed article rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens import schemas
from newslens.functions.columns import let
from newslens.functions.strings import url_path

_LD_BLOCK = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"


def linked_data(html: Column) -> Column:
    """``struct<article, breadcrumbs>`` from the first and second JSON-LD block."""
    return let(
        F.regexp_extract_all(html, F.lit(_LD_BLOCK), F.lit(1)),
        lambda blocks: F.struct(
            F.from_json(F.get(blocks, F.lit(0)), schemas.LD_ARTICLE).alias("article"),
            F.from_json(F.get(blocks, F.lit(1)), schemas.LD_BREADCRUMBS).alias("breadcrumbs"),
        ),
    )


def _starts_with_any(text: Column, prefixes: Sequence[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | text.startswith(prefix)
    return hit


def is_company_news(
    headline: Column,
    description: Column,
    body: Column,
    crumbs: Column,
    skipped_headlines: Sequence[str] = fv.SKIPPED_HEADLINE_PREFIXES,
    skipped_bodies: Sequence[str] = fv.SKIPPED_BODY_PREFIXES,
    section: str = fv.REQUIRED_SECTION,
) -> Column:
    """Keep rule for crawled pages. ``crumbs`` is the array of breadcrumb structs."""
    keep = (
        body.isNotNull()
        & description.isNotNull()
        & ~_starts_with_any(headline, skipped_headlines)
        & ~_starts_with_any(body, skipped_bodies)
        & (F.size(crumbs) >= fv.MIN_BREADCRUMBS)
        & (F.get(crumbs, F.lit(1))["name"] == section)
    )
    return F.coalesce(keep, F.lit(False))


# Dates as web pages write them beside ISO 8601, with time and zone or without; the weekday is dropped first.
DATE_FORMATS = (
    "d MMM yyyy[ H:mm[:ss]][ z]",
    "d MMM yyyy[ H:mm[:ss]][ xx]",
    "d MMMM yyyy[ H:mm[:ss]][ z]",
    "MMM d, yyyy[ H:mm[:ss]][ z]",
    "MMMM d, yyyy[ H:mm[:ss]][ z]",
    "yyyy/M/d[ H:mm[:ss]][ z]",
    "M/d/yyyy[ H:mm[:ss]][ z]",
)
_WEEKDAY = r"^\s*(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?,?\s+)?"


def published_at(text: Column) -> Column:
    """Timestamp of a publication date: ISO 8601, RFC 822 (``Mon, 3 Jan 2022 05:00:00 GMT``) and the other
    :data:`DATE_FORMATS`; NULL for anything else. A date without a zone is in the session's."""
    plain = F.trim(F.regexp_replace(text, _WEEKDAY, ""))
    return F.coalesce(
        F.try_to_timestamp(text), *[F.try_to_timestamp(plain, F.lit(f)) for f in DATE_FORMATS]
    )


def extract_articles(
    pages: DataFrame,
    page_id: str = "page_id",
    html: str = "html",
    source: str = fv.ARTICLE_SOURCE,
) -> DataFrame:
    """One typed row per page that is company news. Narrow: no shuffle."""
    parsed = pages.select(F.col(page_id), linked_data(F.col(html)).alias("ld"))
    fields = parsed.select(
        F.col(page_id), "ld.article.*", F.col("ld.breadcrumbs.itemListElement").alias("crumbs")
    )
    topic = F.get("crumbs", F.lit(2))
    return fields.where(
        is_company_news(
            F.col("headline"), F.col("description"), F.col("articleBody"), F.col("crumbs")
        )
    ).select(
        page_id,
        "headline",
        "description",
        topic["name"].alias("topic"),
        url_path(topic["item"]).alias("topic_url_path"),
        F.col("articleBody").alias("text"),
        published_at(F.col("datePublished")).alias("date_published"),
        F.lit(source).alias("source"),
    )
