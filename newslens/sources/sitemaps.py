"""Sitemap and robots texts to page URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.strings import file_name
from newslens.settings import stored

INDEX_ROOT = "sitemapindex"
URLSET_ROOT = "urlset"
_LINK = "array<struct<_rel:string,_href:string>>"


def kept_by_year(loc: Column, year: int | None) -> Column:
    """Year rule of an index: without a year everything stays; with one, the news
    sitemap and other archive years go, file names without a year stay."""
    if not year:
        return F.lit(True)
    found = F.regexp_extract(file_name(loc), fv.ARCHIVE_YEAR_PATTERN, 1)
    return ~loc.endswith(fv.NEWS_SITEMAP_SUFFIX) & found.isin("", str(year))


def sitemap_type(body: Column) -> Column:
    return F.regexp_extract(body, rf"<(?:\w+:)?({INDEX_ROOT}|{URLSET_ROOT})[\s>]", 1)


def _prefixes_removed(body: Column) -> Column:
    return F.regexp_replace(body, r"(</?)\w+:(\w)", "$1$2")


def entries(fetched: DataFrame, url: str, body: str, year: int | None = None) -> DataFrame:
    """One row per kept entry: the sitemap's url and type, ``loc``, ``alternates``."""
    xml = _prefixes_removed(F.col(body))
    parsed = fetched.select(
        F.col(url).alias("sitemap"),
        sitemap_type(F.col(body)).alias("type"),
        F.from_xml(xml, "sitemap array<struct<loc:string>>")["sitemap"].alias("children"),
        F.from_xml(xml, f"url array<struct<loc:string,link:{_LINK}>>")["url"].alias("pages"),
    )
    no_links = F.array().cast("array<string>")
    located = parsed.select(
        "sitemap",
        "type",
        F.explode(
            F.when(
                F.col("type") == INDEX_ROOT,
                F.transform(
                    "children", lambda e: F.struct(e["loc"].alias("loc"), no_links.alias("alternates"))
                ),
            ).otherwise(
                F.transform(
                    "pages",
                    lambda e: F.struct(
                        e["loc"].alias("loc"),
                        F.coalesce(
                            F.transform(
                                F.filter(e["link"], lambda a: a["_rel"] == "alternate"),
                                lambda a: a["_href"],
                            ),
                            no_links,
                        ).alias("alternates"),
                    ),
                )
            )
        ).alias("entry"),
    )
    loc = F.trim(F.col("entry.loc"))
    return located.select(
        "sitemap", "type", loc.alias("loc"), F.col("entry.alternates").alias("alternates")
    ).where(kept_by_year(F.col("loc"), year))


def expand(
    fetched: DataFrame,
    roots: DataFrame,
    url: str = "url",
    body: str = "body",
    year: int | None = None,
    alternate_links: bool = False,
) -> DataFrame:
    """Page URLs reachable from the roots through any number of index files.

    ``fetched(url, body)`` holds the texts, ``roots(url)`` the start URLs: sitemaps or
    robots files. The walk goes on until no unvisited file is found, so nested and
    circular index files are followed to the end. One row per sitemap and page.
    """
    listed = stored(entries(fetched, url, body, year), "sitemap-entries")
    robots = fetched.where(F.col(url).rlike(r"(?i)/robots\.txt$"))
    links = listed.where(F.col("type") == INDEX_ROOT).select(F.col("sitemap").alias("file"), F.col("loc").alias("next"))
    links = links.unionByName(
        robots_sitemaps(robots, url, body).select(F.col("robots").alias("file"), F.col("sitemap").alias("next"))
    )
    links = stored(links.distinct(), "sitemap-links")
    frontier = stored(roots.select(F.col(url).alias("file")).distinct(), "sitemaps-seen")
    seen = frontier
    while not frontier.isEmpty():
        found = links.join(frontier, "file", "left_semi").select(F.col("next").alias("file")).distinct()
        frontier = stored(found.join(seen, "file", "left_anti"), "sitemaps-seen")
        seen = seen.unionByName(frontier)
    here = listed.where(F.col("type") == URLSET_ROOT).join(
        seen.select(F.col("file").alias("sitemap")), "sitemap", "left_semi"
    )
    if alternate_links:
        urls = F.concat(F.array("loc"), F.col("alternates"))
        return here.select("sitemap", F.explode(urls).alias("page_url")).distinct()
    return here.select("sitemap", F.col("loc").alias("page_url")).distinct()


def _absolute(link: Column, base: Column) -> Column:
    """A link as the file at ``base`` means it: full, host-relative or file-relative."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)//", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)", 1)
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )


def robots_sitemaps(robots: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Sitemap URLs announced by robots files, relative ones made absolute."""
    found = F.regexp_extract_all(F.col(body), F.lit(r"(?im)^\s*sitemap:[ \t]*(\S+)"), F.lit(1))
    return robots.select(F.col(url).alias("robots"), F.explode(found).alias("link")).select(
        "robots", _absolute(F.col("link"), F.col("robots")).alias("sitemap")
    )
