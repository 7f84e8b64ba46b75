"""Queries on pages, names, entities and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens import schemas
from newslens.catalog import fixtures as fx
from newslens.catalog import SQL, register
from newslens.catalog.relational import HI, LO
from newslens.functions import strings
from newslens.functions import text as tx
from newslens.ml import tagger
from newslens.operators import beams, companies, entities, matching, sentence_ends, summaries
from newslens.plans import enrich
from newslens.settings import shared_dir, stored

from newslens.sources import pages as page_source
from newslens.sources import sitemaps, symbols_json

# --- sitemaps, from the URLs of the pages -----------------------------------

# Files of 50 pages, index files of 10 files; archive years are 2019 to 2024.
_PER_FILE, _PER_INDEX, _YEAR = 50, 10, 2021
_HOST = "https://news.example.com/sitemaps"


def _file_loc(file):
    """Every seventh file is a news file and every fifth has no year in its name."""
    number = file.cast("string")
    return (
        F.when(file % 7 == 6, F.concat(F.lit(f"{_HOST}/"), number, F.lit("-news.xml")))
        .when(file % 5 == 4, F.concat(F.lit(f"{_HOST}/extra-"), number, F.lit(".xml")))
        .otherwise(
            F.concat(
                F.lit(f"{_HOST}/archive-"),
                (file % 6 + 2019).cast("string"),
                F.lit("-"),
                number,
                F.lit(".xml"),
            )
        )
    )


_FILE_LOC = f"""case when {{0}} % 7 = 6 then '{_HOST}/' || {{0}}::varchar || '-news.xml'
  when {{0}} % 5 = 4 then '{_HOST}/extra-' || {{0}}::varchar || '.xml'
  else '{_HOST}/archive-' || ({{0}} % 6 + 2019)::varchar || '-' || {{0}}::varchar || '.xml' end"""
_KEPT = f"(file % 7 <> 6 and (file % 5 = 4 or file % 6 + 2019 = {_YEAR}))"
_FILES = f"files as (select page_id, url, page_id // {_PER_FILE} as file from pages)"


def _index_loc(number):
    return F.concat(F.lit(f"{_HOST}/index-"), number.cast("string"), F.lit(".xml"))


def _xml_escaped(value):
    amp = F.replace(value, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _fetched_sitemaps(spark, sf_dir):
    """Sitemap texts as a crawler would land them; file sizes are fixed."""
    listed = fx.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.floor(F.col("page_id") / _PER_FILE).alias("file")
    )
    loc = _xml_escaped(F.col("url"))
    entry = F.concat(
        F.lit("<url><loc>"),
        loc,
        F.lit('</loc><xhtml:link rel="alternate" href="'),
        loc,
        F.lit('/amp"/></url>'),
    )
    urlsets = (
        listed.groupBy("file")
        .agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("entries"))
        .select(
            _file_loc(F.col("file")).alias("url"),
            F.concat(
                F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
                      'xmlns:xhtml="http://www.w3.org/1999/xhtml">'),
                "entries",
                F.lit("</urlset>"),
            ).alias("body"),
        )
    )
    indexes = (
        listed.select("file")
        .distinct()
        .groupBy(F.floor(F.col("file") / _PER_INDEX).alias("index"))
        .agg(
            F.array_join(
                F.array_sort(
                    F.collect_list(
                        F.concat(F.lit("<sitemap><loc>"), _file_loc(F.col("file")), F.lit("</loc></sitemap>"))
                    )
                ),
                "",
            ).alias("entries")
        )
        .select(
            _index_loc(F.col("index")).alias("url"),
            F.concat(
                F.lit('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                "entries",
                F.lit("</sitemapindex>"),
            ).alias("body"),
        )
    )
    return urlsets.unionByName(indexes), indexes.select("url")


@register(
    "sitemap_urls",
    f"with {_FILES}\nselect {_FILE_LOC.format('file')} as sitemap, url as page_url from files where {_KEPT}",
)
def sitemap_urls(spark, sf_dir):
    fetched, roots = _fetched_sitemaps(spark, sf_dir)
    return sitemaps.expand(fetched, roots, year=_YEAR)


@register(
    "sitemap_urls_alternate",
    f"""with {_FILES}
select {_FILE_LOC.format('file')} as sitemap, unnest([url, url || '/amp']) as page_url from files""",
)
def sitemap_urls_alternate(spark, sf_dir):
    fetched, roots = _fetched_sitemaps(spark, sf_dir)
    return sitemaps.expand(fetched, roots, alternate_links=True)


@register(
    "sitemap_year_filter",
    f"""select page_id, {_FILE_LOC.format('page_id')} as loc from pages
where page_id % 7 <> 6 and (page_id % 5 = 4 or page_id % 6 + 2019 = {_YEAR})""",
)
def sitemap_year_filter(spark, sf_dir):
    located = fx.table(spark, sf_dir, "pages").select(
        "page_id", _file_loc(F.col("page_id")).alias("loc")
    )
    return located.where(sitemaps.kept_by_year(F.col("loc"), _YEAR))


@register(
    "robots_sitemaps",
    """select url as robots, 'https://' || page_id::varchar || '.example.com/index.xml' as sitemap from pages
union all select url, 'https://' || page_id::varchar || '.example.com/news.xml' from pages""",
)
def robots_sitemaps(spark, sf_dir):
    host = F.concat(F.lit("https://"), F.col("page_id").cast("string"), F.lit(".example.com/"))
    body = F.concat(
        F.lit("User-agent: *\nDisallow: /search\nSitemap: "),
        host,
        F.lit("index.xml\n  sitemap:   "),
        host,
        F.lit("news.xml\n# Sitemap none\n"),
    )
    fetched = fx.table(spark, sf_dir, "pages").select("url", body.alias("body"))
    return sitemaps.robots_sitemaps(fetched)


# --- listed securities, from vendor responses -------------------------------


def _landed_responses(spark, sf_dir):
    """Exchange lists and symbol lists as JSON texts of at most 100 records each.
    The last exchange answers without being listed."""
    part = fx.table(spark, sf_dir, "part")
    listed = part.select(
        F.floor(F.col("p_partkey") / 100).alias("file"),
        F.col("p_partkey").alias("key"),
        fx._exchange(F.col("p_partkey")).alias("exchange"),
        F.struct(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("Code"),
            F.col("p_name").alias("Name"),
            F.col("p_type").alias("Country"),
            fx._exchange(F.col("p_partkey")).alias("Exchange"),
            F.lit("USD").alias("Currency"),
            F.lit("Common Stock").alias("Type"),
            F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("Isin"),
        ).alias("record"),
    )
    symbol_lists = listed.groupBy("exchange", "file").agg(
        F.to_json(F.collect_list("record"), {"ignoreNullFields": "false"}).alias("body")
    )
    exchange_lists = (
        listed.where(F.col("exchange") != fx.EXCHANGES[-1])
        .groupBy("file")
        .agg(
            F.to_json(
                F.collect_list(
                    F.struct(F.col("exchange").alias("Code"), F.col("exchange").alias("Name"))
                )
            ).alias("body")
        )
    )
    return exchange_lists, symbol_lists


@register(
    "ingest_symbols_json",
    f"""select 'P' || p_partkey::varchar as code, p_name as name, p_type as country,
  {fx._exchange_sql('p_partkey')} as exchange, 'USD' as currency, 'Common Stock' as type,
  case when p_partkey % 4 <> 0 then p_brand end as isin
from part where {fx._exchange_sql('p_partkey')} <> '{fx.EXCHANGES[-1]}'""",
)
def ingest_symbols_json(spark, sf_dir):
    exchange_lists, symbol_lists = _landed_responses(spark, sf_dir)
    return symbols_json.symbols_from_json(exchange_lists, symbol_lists, "exchange", "body")


# --- article pages ----------------------------------------------------------

_CRUMBS = "case when id % 4 = 3 then 2 else 3 end"
_SECTION = "case when id % 6 = 5 then 'Markets' else 'Companies' end"
_HEADLINE = "case when id % 17 = 1 then 'Letter: ' || headline else headline end"
_BODY = "case when id % 19 = 1 then 'Good morning. ' || text else text end"
_NEWS = f"""id % 4 <> 3 and id % 6 <> 5 and id % 13 <> 1
  and not starts_with({_HEADLINE}, 'Letter') and not starts_with({_HEADLINE}, 'FT Crossword')
  and not starts_with({_BODY}, 'Good morning')
  and not starts_with({_BODY}, 'This article is an on-site version')"""


def _ld_parts(spark, sf_dir):
    """Articles with what makes some of them unwanted: few crumbs, another section,
    a letter, a newsletter, no description."""
    i = F.col("id")
    crumb = "struct<name:string,item:string>"
    home = F.struct(F.lit("Home").alias("name"), F.lit("https://news.example.com/").alias("item"))
    section = F.struct(
        F.when(i % 6 == 5, "Markets").otherwise("Companies").alias("name"),
        F.lit("https://news.example.com/companies").alias("item"),
    )
    topic = F.struct(
        F.col("topic").alias("name"),
        F.concat(F.lit("https://news.example.com"), "topic_url_path", F.lit("?ref=crumb")).alias("item"),
    )
    return fx.articles(spark, sf_dir).select(
        "id",
        F.when(i % 17 == 1, F.concat(F.lit("Letter: "), "headline")).otherwise(F.col("headline")).alias("headline"),
        F.when(i % 13 != 1, F.col("description")).alias("description"),
        F.when(i % 19 == 1, F.concat(F.lit("Good morning. "), "text")).otherwise(F.col("text")).alias("articleBody"),
        F.when(i % 3 == 2, F.date_format("date_published", "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
        .when(i % 9 == 1, F.date_format("date_published", "MMMM d, yyyy H:mm:ss"))
        .otherwise(F.date_format("date_published", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("datePublished"),
        F.when(i % 4 == 3, F.array(home, section))
        .otherwise(F.array(home, section, topic))
        .cast(f"array<{crumb}>")
        .alias("crumbs"),
    )


@register(
    "extract_articles_jsonld",
    fx.with_sql(fx.ARTICLES)
    + f"""select id as page_id, {_HEADLINE} as headline, description, topic, topic_url_path, {_BODY} as text,
  strftime(date_published, '%Y-%m-%d %H:%M:%S') as published, 'FT' as source from articles where {_NEWS}""",
)
def extract_articles_jsonld(spark, sf_dir):
    script = '<script type="application/ld+json">'

    def embedded(value):
        """JSON as it stands in a page: a closing tag in it is escaped."""
        return F.replace(F.to_json(value), F.lit("</"), F.lit("<\\/"))

    html = F.concat(
        F.lit(f"<html><head>{script}"),
        embedded(F.struct("headline", "description", "articleBody", "datePublished")),
        F.lit(f"</script>\n{script}"),
        embedded(F.struct(F.col("crumbs").alias("itemListElement"))),
        F.lit("</script></head><body><article>...</article></body></html>"),
    )
    pages = _ld_parts(spark, sf_dir).select(F.col("id").alias("page_id"), html.alias("html"))
    found = page_source.extract_articles(pages)
    return found.withColumn(
        "published", F.date_format("date_published", "yyyy-MM-dd HH:mm:ss")
    ).drop("date_published")


@register("article_quality_filter", fx.with_sql(fx.ARTICLES) + f"select id from articles where {_NEWS}")
def article_quality_filter(spark, sf_dir):
    keep = page_source.is_company_news(
        F.col("headline"), F.col("description"), F.col("articleBody"), F.col("crumbs")
    )
    return _ld_parts(spark, sf_dir).where(keep).select("id")


@register(
    "url_path",
    "select page_id, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) as path from pages",
)
def url_path(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", strings.url_path(F.col("url")).alias("path")
    )


# --- names ------------------------------------------------------------------

_NAME_GRAMS = """grams as (
  select name, substring(lower(name), p, 3) as gram, count(*) as tf
  from (select name, unnest(range(1, length(name) - 1)) as p from {0} where length(name) >= 3) group by 1, 2)"""


@register(
    "char_ngrams",
    """select p_partkey as id, p as pos, substring(lower(p_name), p, 3) as gram
from (select p_partkey, p_name, unnest(range(1, length(p_name) - 1))::int as p from part where length(p_name) >= 3)""",
)
def char_ngrams(spark, sf_dir):
    return (
        fx.table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("id"), F.posexplode(tx.char_ngrams(F.col("p_name"))).alias("pos", "gram"))
        .withColumn("pos", F.col("pos") + 1)
    )


@register(
    "ngram_idf",
    """with grams as (
  select p_partkey, substring(lower(p_name), p, 3) as gram
  from (select p_partkey, p_name, unnest(range(1, length(p_name) - 1)) as p from part) group by 1, 2)
select gram, count(*) as df, round(ln(((select count(*) from part) + 1.0) / (count(*) + 1)), 6) as idf
from grams group by gram""",
)
def ngram_idf(spark, sf_dir):
    names = fx.table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    return matching.ngram_idf(names).withColumn("idf", F.round("idf", 6))


_KNN_PARTS = (
    "q as (select distinct lower(corp) as name from ticker_names where length(corp) >= 3)",
    """ig as (select id, substring(lower(name), p, 3) as g, count(*) as tf
  from (select id, name, unnest(range(1, length(name) - 1)) as p from symbols) group by 1, 2)""",
    """qg as (select name, substring(name, p, 3) as g, count(*) as tf
  from (select name, unnest(range(1, length(name) - 1)) as p from q) group by 1, 2)""",
    "m as (select count(*)::double as m from symbols)",
    "df as (select g, ln(((select m from m) + 1) / (count(*) + 1)) as idf from ig group by 1)",
    "iw as (select id, ig.g, tf * idf as w from ig join df on ig.g = df.g)",
    """qw as (select name, qg.g, tf * coalesce(idf, ln((select m from m) + 1)) as w
  from qg left join df on qg.g = df.g)""",
    "inorm as (select id, sqrt(sum(w * w)) as n from iw group by 1)",
    "qnorm as (select name, sqrt(sum(w * w)) as n from qw group by 1)",
    "dot as (select name, id, sum(qw.w * iw.w) as s from qw join iw on qw.g = iw.g group by 1, 2)",
    f"""near as (select dot.name, dot.id, round(1 - round(s / (inorm.n * qnorm.n), 6), 6) as distance
  from dot join inorm on inorm.id = dot.id join qnorm on qnorm.name = dot.name
  where round(1 - round(s / (inorm.n * qnorm.n), 6), 6) < {fv.DEFAULT_MAX_DISTANCE})""",
    """best as (select name, id, distance from near
  qualify row_number() over (partition by name order by distance, id) = 1)""",
)
_KNN = fx.with_sql(fx.SYMBOLS, fx.TICKER_NAMES, *_KNN_PARTS)


def _matched(spark, sf_dir):
    index = matching.NameIndex.fit(fx.symbols(spark, sf_dir))
    queries = fx.ticker_names(spark, sf_dir).withColumn("name", F.col("corp"))
    return matching.nearest_names(queries, index)


@register(
    "match_tickers_knn",
    _KNN
    + """select t.id, b.id as neighbor, b.distance
from ticker_names t left join best b on b.name = lower(t.corp)""",
)
def match_tickers_knn(spark, sf_dir):
    first = F.get("knn", F.lit(0))
    return _matched(spark, sf_dir).select(
        "id", first["neighbor"].alias("neighbor"), first["distance"].alias("distance")
    )


@register("match_saved_index", SQL["match_tickers_knn"])
def match_saved_index(spark, sf_dir):
    """The index is fitted and saved by one job and loaded by another, which doesn't shuffle it."""
    path = shared_dir(spark, "name-index")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    matching.NameIndex.fit(fx.symbols(spark, sf_dir)).save_bucketed(path, buckets)
    index = matching.NameIndex.load_bucketed(spark, path)
    queries = fx.ticker_names(spark, sf_dir).withColumn("name", F.col("corp"))
    first = F.get("knn", F.lit(0))
    return matching.nearest_names(queries, index).select(
        "id", first["neighbor"].alias("neighbor"), first["distance"].alias("distance")
    )


@register(
    "match_tickers_top3",
    _KNN
    + """select t.id, r.rank::int as rank, r.id as neighbor, r.distance from ticker_names t
join (select *, row_number() over (partition by name order by distance, id) as rank from near) r
  on r.name = lower(t.corp) where r.rank <= 3""",
)
def match_tickers_top3(spark, sf_dir):
    index = matching.NameIndex.fit(fx.symbols(spark, sf_dir))
    queries = fx.ticker_names(spark, sf_dir).withColumn("name", F.col("corp"))
    found = matching.nearest_names(queries, index, k=3)
    return (
        found.select("id", F.posexplode("knn").alias("pos", "n"))
        .select("id", (F.col("pos") + 1).alias("rank"), "n.neighbor", "n.distance")
    )


@register(
    "ticker_lookup",
    _KNN
    + """select t.id, t.corp, s.code as symbol, s.exchange from ticker_names t
left join best b on b.name = lower(t.corp) left join symbols s on s.id = b.id""",
)
def ticker_lookup(spark, sf_dir):
    return matching.match_tickers(fx.ticker_names(spark, sf_dir), fx.symbols(spark, sf_dir))


def _suffix_sql(pattern):
    return f"select p_partkey as id, regexp_matches(lower(p_name || ' ' || p_type), '{pattern}') as company from part"


@register("corp_suffix_match", _suffix_sql(fv.CORP_SUFFIX_PATTERN))
def corp_suffix_match(spark, sf_dir):
    names = fx.ticker_names(spark, sf_dir)
    return names.select("id", strings.has_corp_suffix(F.col("corp")).alias("company"))


@register(
    "corp_suffix_match_strict",
    fx.with_sql(fx.ARTICLES)
    + f"select id, regexp_matches(lower(topic), '{fv.CORP_SUFFIX_PATTERN_STRICT}') as company from articles",
)
def corp_suffix_match_strict(spark, sf_dir):
    topics = fx.articles(spark, sf_dir).select("id", "topic")
    return topics.select("id", strings.has_corp_suffix(F.col("topic"), strict=True).alias("company"))


def levenshtein_sql(a: str, b: str) -> str:
    short = f"case when length({a}) <= length({b}) then {a} else {b} end"
    long = f"case when length({a}) <= length({b}) then {b} else {a} end"
    return f"""coalesce(list_max(list_transform(
  range(1, length({long}) - length({short}) + 2),
  lambda i: round(100 - 100.0 * levenshtein(substring({long}, i, length({short})), {short}) / length({short}), 6))), 0)"""


_PAIRS = fx.with_sql(
    "pairs as (select c_custkey as id, c_name || ' ' || c_mktsegment as a, p_name || ' ' || p_type as b "
    "from customer join part on p_partkey = c_custkey % (select count(*) from part))"
)


def _pairs(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    n = part.agg(F.count("*")).scalar()
    customer = fx.table(spark, sf_dir, "customer").withColumn("p_partkey", F.col("c_custkey") % n)
    return customer.join(part, "p_partkey").select(
        F.col("c_custkey").alias("id"),
        F.concat_ws(" ", "c_name", "c_mktsegment").alias("a"),
        F.concat_ws(" ", "p_name", "p_type").alias("b"),
    )


@register("partial_levenshtein", _PAIRS + f"select id, {levenshtein_sql('a', 'b')} as similarity from pairs")
def partial_levenshtein(spark, sf_dir):
    score = strings.partial_levenshtein(F.col("a"), F.col("b"))
    return _pairs(spark, sf_dir).select("id", score.alias("similarity"))


def ratio_sql(a: str, b: str) -> str:
    """Best insert/delete similarity over all windows, with the common subsequence
    counted bit by bit: one integer per row, one step per character."""

    def best(short: str, long: str) -> str:
        n, window = f"length({short})", f"substring({long}, greatest(i, 0) + 1, least(i + length({short}), length({long})) - greatest(i, 0))"
        mask = f"""list_sum(list_transform(range(0, {n}), lambda p:
          case when substring({short}, p + 1, 1) = c then 1::bigint << p::bigint else 0::bigint end))::bigint"""
        row = f"""list_reduce(list_transform(string_split({window}, ''), lambda c: {mask}),
          lambda r, m: ((r + (r & m)) | (r - (r & m))) & ((1::bigint << {n}) - 1), (1::bigint << {n}) - 1)"""
        return f"""list_max(list_transform(range(1 - {n}, length({long})), lambda i:
          200.0::double * ({n} - bit_count({row})) / ({n} + length({window}))))"""

    return f"""case when coalesce({a}, '') = '' or coalesce({b}, '') = '' then 0
  when length({a}) < length({b}) then round_even({best(a, b)}, 0)
  when length({a}) > length({b}) then round_even({best(b, a)}, 0)
  else round_even(greatest({best(a, b)}, {best(b, a)}), 0) end::int"""


@register("partial_ratio_udf", _PAIRS + f"select id, {ratio_sql('a', 'b')} as similarity from pairs")
def partial_ratio_udf(spark, sf_dir):
    score = strings.partial_ratio("a", "b")
    return _pairs(spark, sf_dir).select("id", score.alias("similarity"))


# --- sentences, words, entities ---------------------------------------------


@register(
    "sentences",
    r"""select doc_id, (generate_subscripts(s, 1) - 1)::int as pos, unnest(s) as sentence
from (select doc_id, regexp_split_to_array(text, '[.!?]\s+') as s from documents)""",
)
def sentences(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))


_WORDS = r"regexp_extract_all(lower({0}), '([\p{{L}}\p{{N}}]+)', 1)"


@register(
    "tokens",
    f"""select doc_id, (generate_subscripts(w, 1) - 1)::int as pos, unnest(w) as word
from (select doc_id, {_WORDS.format('text')} as w from documents)""",
)
def tokens(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(tx.words(F.col("text"))).alias("pos", "word"))


# All fixture names have two words, so a hit is two neighbouring words. Each text
# is cut into words and gaps; offsets are the lengths before.
_ENTITIES = fx.with_sql(
    fx.ARTICLES,
    fx.SYMBOLS,
    "content as (select id, headline || chr(10) || text as content from articles)",
    r"""cut as (select id, generate_subscripts(ps, 1) as pos, unnest(ps) as piece
  from (select id, regexp_extract_all(content, '([\p{L}\p{N}]+|[^\p{L}\p{N}]+)', 1) as ps from content))""",
    """placed as (select id, pos, piece,
    coalesce(sum(length(piece)) over (partition by id order by pos rows between unbounded preceding and 1 preceding), 0) as start,
    lead(piece, 1) over (partition by id order by pos) as gap,
    lead(piece, 2) over (partition by id order by pos) as next
  from cut)""",
    """hits as (select p.id, p.start::int as start, (p.start + length(p.piece || p.gap || p.next) - 1)::int as "end",
    p.piece || p.gap || p.next as word
  from placed p join symbols s on lower(p.piece || ' ' || p.next) = s.name)""",
)


def _tagged(spark, sf_dir):
    content = fx.articles(spark, sf_dir).select(
        "id", F.concat_ws("\n", "headline", "text").alias("content")
    )
    return entities.extract_entities(content, fx.symbols(spark, sf_dir), {"content": "entities"})


@register(
    "extract_entities",
    _ENTITIES + """select id, 'ORG' as entity_group, '1.0' as score, word, start, "end" from hits""",
)
def extract_entities(spark, sf_dir):
    return _tagged(spark, sf_dir).select("id", F.explode("entities").alias("e")).select("id", "e.*")


@register(
    "org_entities",
    _ENTITIES + "select c.id, count(h.id)::int as orgs from content c left join hits h on h.id = c.id group by 1",
)
def org_entities(spark, sf_dir):
    orgs = entities.entities_of_group(F.col("entities"))
    return _tagged(spark, sf_dir).select("id", F.size(orgs).alias("orgs"))


@register("tag_organisations")
def tag_organisations(spark, sf_dir):
    """A tagger trained on four fifths of the gazetteer's rows, on all rows: spans found, listed, and in both."""
    held_out = F.crc32(F.col("id").cast("string")) % 5 == 1
    rows = stored(_tagged(spark, sf_dir).select("id", "content", "entities", held_out.alias("held_out")), "tagged")
    weights = tagger.train(rows.where("not held_out"), "content", "entities")
    found = rows.withColumn("found", tagger.organisations(rows, weights, "content"))
    listed = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    both = F.size(F.array_intersect("found", listed))
    return found.select("id", "held_out", F.size("found").alias("found"), F.size("entities").alias("listed"), both.alias("both"))


def _orgs(spark, sf_dir):
    """Organisations in headline, description and summary (here: the source line)."""
    content = fx.articles(spark, sf_dir).select("id", "topic", "headline", "description", "source")
    return companies.find_organisations(
        content, fx.symbols(spark, sf_dir), ("headline", "description", "source")
    )


def _candidate_parts(third: str, source: str) -> tuple[str, ...]:
    """Names in the headline, the description and a third column of a table."""
    ws = r"regexp_extract_all({0}, '([\p{{L}}\p{{N}}]+)', 1)"
    return (
        f"""cut as (select id, col, generate_subscripts(ws, 1) as pos, unnest(ws) as w from (
    select id, 1 as col, {ws.format('headline')} as ws from {source}
    union all select id, 2, {ws.format('description')} from {source}
    union all select id, 3, {ws.format(third)} from {source}))""",
        """pairs as (select id, lower(w || ' ' || lead(w) over (partition by id, col order by pos)) as gram,
    w || ' ' || lead(w) over (partition by id, col order by pos) as word from cut)""",
        "found as (select distinct p.id, p.word from pairs p join symbols s on s.name = p.gram)",
    )


_CANDIDATES = fx.with_sql(fx.ARTICLES, fx.SYMBOLS, *_candidate_parts("source", "articles"))


def _resolved_sql(source: str, score=levenshtein_sql) -> str:
    return f"""select id, topic, similarity, case when similarity > {fv.COMPANY_SIMILARITY_THRESHOLD}
    or regexp_matches(lower(topic), '{fv.CORP_SUFFIX_PATTERN}') then topic else '' end as corp
from (select a.id, a.topic, coalesce(max({score('a.topic', 'f.word')}), 0) as similarity
  from {source} a left join found f on f.id = a.id group by 1, 2)"""


@register(
    "org_candidates",
    _CANDIDATES
    + """select a.id, coalesce(string_agg(f.word, '|' order by f.word), '') as orgs
from articles a left join found f on f.id = a.id group by 1""",
)
def org_candidates(spark, sf_dir):
    words = F.transform("orgs", lambda o: F.regexp_replace(o, r"[^\p{L}\p{N}]+", " "))
    return _orgs(spark, sf_dir).select(
        "id", F.array_join(F.array_sort(F.array_distinct(words)), "|").alias("orgs")
    )


@register(
    "explode_orgs_outer",
    _CANDIDATES + "select a.id, f.word as org from articles a left join found f on f.id = a.id",
)
def explode_orgs_outer(spark, sf_dir):
    words = F.transform("orgs", lambda o: F.regexp_replace(o, r"[^\p{L}\p{N}]+", " "))
    return _orgs(spark, sf_dir).select("id", F.explode_outer(F.array_distinct(words)).alias("org"))


@register(
    "resolve_company",
    _CANDIDATES + _resolved_sql("articles"),
)
def resolve_company(spark, sf_dir):
    resolved = companies.resolve_company(
        _orgs(spark, sf_dir), similarity=companies.best_levenshtein
    )
    return resolved.select("id", "topic", "similarity", "corp")


@register("resolve_company_ratio", _CANDIDATES + _resolved_sql("articles", ratio_sql))
def resolve_company_ratio(spark, sf_dir):
    return companies.resolve_company(_orgs(spark, sf_dir)).select("id", "topic", "similarity", "corp")


# --- summaries --------------------------------------------------------------


def summary_sql(key: str, text: str, source: str) -> tuple[str, ...]:
    return (
        rf"""sent as (select id, (generate_subscripts(s, 1) - 1) as pos, unnest(s) as sentence
  from (select {key} as id, regexp_split_to_array({text}, '[.!?]\s+') as s from {source}))""",
        f"tok as (select id, pos, unnest({_WORDS.format('sentence')}) as word from sent)",
        "freq as (select id, word, count(*) as n from tok group by 1, 2)",
        "size as (select id, sum(n)::bigint as total from freq group by 1)",
        """scored as (select t.id, t.pos, count(*) as n_words,
    round(sum(f.n)::bigint / (count(*) * any_value(s.total)), 6) as score
  from tok t join freq f on f.id = t.id and f.word = t.word join size s on s.id = t.id
  group by 1, 2 having count(*) >= 3)""",
        f"""ranked as (select *, sum(n_words) over (partition by id order by score desc, pos
    rows between unbounded preceding and current row)::bigint as upto from scored)""",
        f"""chosen as (select r.id, r.pos, case when r.upto <= {fv.SUMMARY_MAX_LENGTH} then s.sentence
    else array_to_string(list_slice(regexp_split_to_array(s.sentence, '\\s+'), 1,
      {fv.SUMMARY_MAX_LENGTH} - (r.upto - r.n_words)), ' ') end as sentence
  from ranked r join sent s on s.id = r.id and s.pos = r.pos
  where r.upto <= {fv.SUMMARY_MAX_LENGTH} or r.upto - r.n_words < {fv.SUMMARY_MIN_LENGTH})""",
        f"""summarized as (select d.{key} as id, coalesce(string_agg(c.sentence, '. ' order by c.pos), '') as summary
  from {source} d left join chosen c on c.id = d.{key} group by 1)""",
    )


@register(
    "summarize_extractive",
    fx.with_sql(*summary_sql("doc_id", "text", "documents")) + "select id, summary from summarized",
)
def summarize_extractive(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return summaries.summarize_extractive(docs)


@register("summarize_beams")
def summarize_beams(spark, sf_dir):
    """Four beams, 50 to 100 words, length penalty 2.0."""
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return beams.summarize_beams(docs)


# --- learned sentence ends ---------------------------------------------------

_ABBREVIATIONS = rf"""tok as (
  select unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+(?:\.[\p{{L}}\p{{N}}]+)*\.?')) as t from documents),
counts as (
  select rtrim(t, '.') as word, count(*) as n, count(*) filter (t like '%.') as n_period from tok group by 1),
share as (select sum(n_period)::double / sum(n) as p from counts),
scored as (
  select word, n, n_period, length(replace(word, '.', ''))::double as letters, round(2 * (
      n_period * (ln({sentence_ends.ALWAYS}::double) - ln(p))
      + (n - n_period) * (ln(1 - {sentence_ends.ALWAYS}::double) - ln(1 - p)))
    * exp(-letters) * (length(word) - letters + 1) * pow(letters, -(n - n_period)::double), {sentence_ends.PLACES}) as score
  from counts, share where n_period > 0 and regexp_matches(word, '\p{{L}}') and p > 0 and p < 1),
abbreviations as (select word, n, n_period, score from scored where score >= {sentence_ends.THRESHOLD})"""


@register("abbreviations", fx.with_sql(_ABBREVIATIONS) + "select * from abbreviations")
def abbreviations(spark, sf_dir):
    counts = stored(sentence_ends.count_periods(fx.table(spark, sf_dir, "documents")), "words")
    return sentence_ends.abbreviations(counts)


@register(
    "sentences_learned",
    fx.with_sql(
        _ABBREVIATIONS,
        r"""cut as (
  select doc_id, (generate_subscripts(s, 1) - 1) as place, unnest(s) as part from (
    select doc_id, string_split(regexp_replace(text, '([.!?])(\s)', '\1' || chr(31) || '\2', 'g'), chr(31)) as s from documents))""",
        r"""ends as (
  select doc_id, place, part, regexp_extract(lower(part), '([\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*)\.$', 1)
    in (select word from abbreviations) as open from cut)""",
        """numbered as (select doc_id, place, part, coalesce(sum((not open)::int) over (
  partition by doc_id order by place rows between unbounded preceding and 1 preceding), 0) as sentence_no from ends)""",
        r"""sents as (select doc_id, sentence_no, regexp_replace(string_agg(part, '' order by place), '^\s+|\s+$', '', 'g') as sentence
  from numbered group by 1, 2)""",
    )
    + """select doc_id as id, (row_number() over (partition by doc_id order by sentence_no) - 1)::int as pos, sentence
from sents where sentence <> ''""",
)
def sentences_learned(spark, sf_dir):
    """Every document cut into sentences, abbreviations learned from all of them."""
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    counts = stored(sentence_ends.count_periods(docs), "words")
    return sentence_ends.split_sentences(docs, sentence_ends.abbreviations(counts))


# --- the chain of stages ----------------------------------------------------


def chain_parts(score) -> tuple[str, ...]:
    """From articles to the nearest listed name of each company found, ``best``."""
    return (
        fx.ARTICLES,
        fx.SYMBOLS,
        *summary_sql("id", "text", "articles"),
        """todo as (select a.*, s.summary from articles a join summarized s on s.id = a.id
  where starts_with(a.topic_url_path, '/stream'))""",
        *_candidate_parts("summary", "todo"),
        f"resolved as ({_resolved_sql('todo', score)})",
        f"""ticker_names as (select r.id, r.corp from resolved r join articles a on a.id = r.id
  where r.corp <> '' and a.date_published > timestamp '{LO} 00:00:00'
    and a.date_published < timestamp '{HI} 00:00:00')""",
        *_KNN_PARTS,
    )


def nothing_done(spark) -> enrich.StageTables:
    bar = "date:date,open:double,adjusted_close:double"
    return enrich.StageTables(
        summaries=spark.createDataFrame([], "id long, summary string"),
        companies=spark.createDataFrame([], "id long, corp string"),
        tickers=spark.createDataFrame([], "id long, symbol string, exchange string"),
        article_prices=spark.createDataFrame([], f"id long, prices array<struct<{bar}>>"),
        predictions=spark.createDataFrame([], "id long, prediction string"),
    )


@register(
    "enrich_articles",
    fx.with_sql(*chain_parts(levenshtein_sql))
    + """select s.id, s.summary, r.corp, y.code as symbol, y.exchange, t.id is not null as tried
from summarized s left join resolved r on r.id = s.id left join ticker_names t on t.id = s.id
left join best b on b.name = lower(t.corp) left join symbols y on y.id = b.id""",
)
def enrich_articles(spark, sf_dir):
    articles = stored(fx.articles(spark, sf_dir), "articles")
    done = enrich.enrich_articles(
        articles,
        fx.symbols(spark, sf_dir),
        nothing_done(spark),
        LO,
        HI,
        similarity=companies.best_levenshtein,
    )
    tickers = done.tickers.withColumn("tried", F.lit(True))
    return (
        done.summaries.join(done.companies, "id", "left")
        .join(tickers, "id", "left")
        .withColumn("tried", F.coalesce("tried", F.lit(False)))
    )
