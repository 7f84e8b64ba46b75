import json

import pytest
from pyspark.sql import functions as F

from newslens import schemas
from newslens.settings import JobSettings, shared_dir
from newslens.sources import pages, sitemaps, symbols_json

INDEX = """<?xml version="1.0" encoding="UTF-8"?>
<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
<sitemap><loc>https://x.com/s/news.xml</loc></sitemap>
<sitemap><loc> https://x.com/s/archive-2020-1.xml </loc></sitemap>
<sitemap><loc>https://x.com/s/archive-2021-1.xml</loc></sitemap>
<sitemap><loc>https://x.com/s/other.xml</loc></sitemap></sitemapindex>"""


def urlset(*locs):
    inner = "".join(
        f'<url><loc>{u}</loc><xhtml:link rel="alternate" hreflang="de" href="{u}/de"/></url>' for u in locs
    )
    return (
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
        f'xmlns:xhtml="http://www.w3.org/1999/xhtml">{inner}</urlset>'
    )


@pytest.fixture
def fetched(spark):
    return spark.createDataFrame(
        [
            ("https://x.com/index.xml", INDEX),
            ("https://x.com/s/news.xml", urlset("https://x.com/n")),
            ("https://x.com/s/archive-2020-1.xml", urlset("https://x.com/a")),
            ("https://x.com/s/archive-2021-1.xml", urlset("https://x.com/b")),
            ("https://x.com/s/other.xml", urlset("https://x.com/c")),
            ("https://x.com/s/unlinked.xml", urlset("https://x.com/d")),
            ("https://x.com/broken.xml", "<not closed"),
        ],
        "url string, body string",
    )


@pytest.mark.parametrize(
    "year, expected", [(None, "abcn"), (2020, "ac"), (2021, "bc"), (1999, "c")]
)
def test_year_rule(spark, fetched, year, expected):
    roots = spark.createDataFrame([("https://x.com/index.xml",)], "url string")
    out = sitemaps.expand(fetched, roots, year=year)
    assert "".join(sorted(r.page_url[-1] for r in out.collect())) == expected


def test_alternate_links_and_direct_urlset(spark, fetched):
    roots = spark.createDataFrame([("https://x.com/s/news.xml",)], "url string")
    out = sitemaps.expand(fetched, roots, alternate_links=True)
    assert sorted(r.page_url for r in out.collect()) == ["https://x.com/n", "https://x.com/n/de"]


def test_walk_goes_to_the_end_and_lists_a_page_once(spark):
    def index(*locs):
        inner = "".join(f"<sitemap><loc>https://x.com/{u}</loc></sitemap>" for u in locs)
        return f"<sitemapindex>{inner}</sitemapindex>"

    fetched = spark.createDataFrame(
        [
            ("https://x.com/robots.txt", "Sitemap: /1.xml\nSitemap: /d.xml"),
            ("https://x.com/1.xml", index("2.xml", "d.xml")),
            ("https://x.com/2.xml", index("3.xml", "1.xml")),  # back to its own index
            ("https://x.com/3.xml", index("4.xml")),
            ("https://x.com/4.xml", index("deep.xml")),
            ("https://x.com/deep.xml", urlset("https://x.com/p")),
            ("https://x.com/d.xml", urlset("https://x.com/q")),
        ],
        "url string, body string",
    )
    roots = spark.createDataFrame([("https://x.com/robots.txt",), ("https://x.com/d.xml",)], "url string")
    out = sorted(r.page_url for r in sitemaps.expand(fetched, roots).collect())
    assert out == ["https://x.com/p", "https://x.com/q"]
    assert sitemaps.expand(fetched, roots.limit(0)).count() == 0


def test_robots(spark):
    text = (
        "User-agent: *\r\nSitemap: https://a/1.xml\r\n sitemap:https://a/2.xml\n#Sitemap: no\n"
        "SITEMAP: /3.xml\nSitemap: 4.xml\nSitemap: //b/5.xml\nSitemap:\n"
    )
    df = spark.createDataFrame([("https://x.com/d/robots.txt", text)], "url string, body string")
    assert [r.sitemap for r in sitemaps.robots_sitemaps(df).collect()] == [
        "https://a/1.xml", "https://a/2.xml", "https://x.com/3.xml", "https://x.com/d/4.xml", "https://b/5.xml",
    ]


def page(article, crumbs=("Home", "Companies", "Oil")):
    items = [{"name": c, "item": f"https://x.com/{c}?q#f"} for c in crumbs]
    return (
        f'<script type="application/ld+json">{json.dumps(article)}</script><p>x</p>'
        f"<SCRIPT data-x='1' type='application/ld+json'>{json.dumps({'itemListElement': items})}</SCRIPT>"
    )


ARTICLE = {
    "headline": "Oil up", "description": "d", "articleBody": "text", "datePublished": "2022-07-20T10:00:00.000+02:00",
}


def test_article_pages(spark):
    html = [
        page(ARTICLE),
        page({**ARTICLE, "headline": "Letter: no"}),
        page({**ARTICLE, "headline": "FT Crossword 1"}),
        page({**ARTICLE, "articleBody": "Good morning all"}),
        page({**ARTICLE, "articleBody": "This article is an on-site version of"}),
        page({k: v for k, v in ARTICLE.items() if k != "description"}),
        page({k: v for k, v in ARTICLE.items() if k != "articleBody"}),
        page(ARTICLE, ("Home", "Companies")),
        page(ARTICLE, ("Home", "Markets", "Oil")),
        "<html>no data</html>",
        page({**ARTICLE, "datePublished": "never"}),
    ]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    out = {r.page_id: r for r in pages.extract_articles(df).collect()}
    assert sorted(out) == [0, 10]
    row = out[0]
    assert (row.topic, row.topic_url_path, row.source) == ("Oil", "/Oil", "FT")
    assert str(row.date_published) == "2022-07-20 08:00:00" and out[10].date_published is None


def test_symbol_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"Code": "A", "Name": "Alpha", "Isin": None}, {"Code": "B"}]))
    (tmp_path / "b.json").write_text(json.dumps([{"Code": "C", "Exchange": "US"}]))
    read = symbols_json.read_responses(spark, str(tmp_path), schemas.VENDOR_SYMBOL)
    out = symbols_json.lower_keys(read)
    assert out.columns == ["code", "name", "country", "exchange", "currency", "type", "isin"]
    assert sorted(r.code for r in out.collect()) == ["A", "B", "C"]
    asked = spark.createDataFrame([("US", "1")], "e string, d string")
    path = asked.select(symbols_json.symbol_list_request(F.col("e"), F.col("d"))).first()[0]
    assert path == "exchange-symbol-list/US?fmt=json&delisted=1"


def test_settings_and_shared_folder(spark, tmp_path):
    f = tmp_path / "models.json"
    f.write_text('{"max_distance": 0.3}')
    assert JobSettings.from_json_files(str(f)).max_distance == 0.3
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base)


def test_publication_dates_in_other_forms(spark):
    want = {
        "Mon, 3 Jan 2022 05:00:00 GMT": "2022-01-03 05:00:00", "Monday 3 Jan 2022": "2022-01-03 00:00:00",
        "3 Jan 2022 05:00:00 +0100": "2022-01-03 04:00:00", "January 13, 2022": "2022-01-13 00:00:00",
        "Jan 3, 2022 7:05": "2022-01-03 07:05:00", "2022/1/3 17:05:09": "2022-01-03 17:05:09", "12/31/2021": "2021-12-31 00:00:00",
        "2022-01-03T05:00:00Z": "2022-01-03 05:00:00", "32 Jan 2022": None, "": None, None: None, "soon": None,
    }
    df = spark.createDataFrame([(k,) for k in want], "v string")
    got = df.select("v", pages.published_at(F.col("v")).alias("t")).collect()
    assert {r.v: None if r.t is None else str(r.t) for r in got} == want
