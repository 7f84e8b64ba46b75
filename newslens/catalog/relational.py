"""Queries on scans, keyed writes, stages and the feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from newslens import schemas
from newslens.catalog import fixtures as fx
from newslens.catalog import SQL, register
from newslens.functions.strings import article_text as compose_text
from newslens.functions.strings import normalize_exchange as to_vendor_code
from newslens.operators import feed, merge, stages
from newslens.settings import shared_dir
from newslens.sources import keyed, tables

# Dates of the fixture's open ranges; a few articles carry exactly these stamps.
LO, HI = date(2024, 1, 7), date(2024, 1, 25)
AS_OF = date(2024, 1, 30)
_RANGE = f"date_published > timestamp '{LO} 00:00:00' and date_published < timestamp '{HI} 00:00:00'"
_STAGES = fx.with_sql(*fx.STAGES)

_DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("scan_articles", "select doc_id as id, text, source from documents where text is not null")
def scan_articles(spark, sf_dir):
    schema = schemas.T._parse_datatype_string(_DOCUMENTS)
    scanned = tables.scan(spark, f"{sf_dir}/documents.parquet", schema, ["doc_id", "text", "source"])
    return scanned.where(F.col("text").isNotNull()).withColumnRenamed("doc_id", "id")


@register("scan_symbols", fx.with_sql(fx.SYMBOLS) + "select id, name, code, exchange from symbols")
def scan_symbols(spark, sf_dir):
    return fx.symbols(spark, sf_dir)


# --- keyed writes -----------------------------------------------------------

# Updates to orders: line items change price and clear or set the priority.
_UPDATES = """updates as (
  select l_orderkey as o_orderkey, max(l_extendedprice) as o_totalprice,
    case when max(l_tax) > 0.05 then 'LATE' end as o_orderpriority
  from lineitem group by 1)"""


def _order_updates(spark, sf_dir):
    return (
        fx.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_extendedprice").alias("o_totalprice"),
            F.when(F.max("l_tax") > 0.05, "LATE").alias("o_orderpriority"),
        )
    )


def _order_base(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@register(
    "merge_partial_update",
    f"""with {_UPDATES}
select coalesce(b.o_orderkey, u.o_orderkey) as o_orderkey, b.o_orderstatus,
  case when u.o_orderkey is not null then u.o_totalprice else b.o_totalprice end as o_totalprice,
  case when u.o_orderkey is not null then u.o_orderpriority else b.o_orderpriority end as o_orderpriority
from orders b full join updates u on u.o_orderkey = b.o_orderkey""",
)
def merge_partial_update(spark, sf_dir):
    return merge.partial_update(
        _order_base(spark, sf_dir), _order_updates(spark, sf_dir), ["o_orderkey"]
    )


@register("merge_keyed_table", SQL["merge_partial_update"])
def merge_keyed_table(spark, sf_dir):
    """The same update, in place of a stored table and by the folders it touches, in two steps."""
    path = shared_dir(spark, "orders")
    orders = keyed.KeyedTable.create(_order_base(spark, sf_dir), path, ["o_orderkey"], 16)
    updates = _order_updates(spark, sf_dir)
    for half in (0, 1):
        orders.update(updates.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(16)) % 2 == half))
    return orders.read()


@register(
    "update_prices_no_insert",
    """with bars as (
  select l_suppkey, max(l_extendedprice) as price, count(*) as bars from lineitem group by 1)
select s.s_suppkey, s.s_name, case when b.l_suppkey is not null then b.price else s.s_acctbal end as s_acctbal,
  b.bars from supplier s left join bars b on b.l_suppkey = s.s_suppkey""",
)
def update_prices_no_insert(spark, sf_dir):
    base = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    updates = (
        fx.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.max("l_extendedprice").alias("s_acctbal"), F.count("*").alias("bars"))
    )
    return merge.partial_update(base, updates, ["s_suppkey"], insert=False)


# The crawl repeats headlines: documents of all sources are the stored articles,
# conversation turns and documents are new finds in order of arrival.
_HEADLINES = """found as (
  select split_part(text, chr(10), 1) as headline, doc_id as seq, 'documents' as origin, text as body
  from documents
  union all
  select split_part(text, chr(10), 1), conv_id * 1000 + turn + 1000000000, 'conversations', text
  from conversations),
  stored as (select split_part(html, chr(10), 1) as headline, min(page_id) as page_id, 'pages' as origin
    from pages group by 1
    union all select split_part(text, chr(10), 1), min(item_id), 'benchmark' from benchmark group by 1),
  last as (select headline, arg_max(origin, seq) as origin, arg_max(body, seq) as body
    from found group by headline)"""


@register(
    "upsert_articles_by_headline",
    f"""with {_HEADLINES}
select coalesce(s.headline, l.headline) as headline, s.page_id,
  case when l.headline is not null then l.origin else s.origin end as origin, l.body
from (select headline, min(page_id) as page_id, min(origin) as origin from stored group by headline) s
full join last l on l.headline = s.headline""",
)
def upsert_articles_by_headline(spark, sf_dir):
    def first_line(column):
        return F.split_part(column, F.lit("\n"), F.lit(1)).alias("headline")

    def found(name, seq):
        return fx.table(spark, sf_dir, name).select(
            first_line(F.col("text")), seq.alias("seq"), F.lit(name).alias("origin"), F.col("text").alias("body")
        )

    updates = found("documents", F.col("doc_id")).unionByName(
        found("conversations", F.col("conv_id") * 1000 + F.col("turn") + 1000000000)
    )

    def stored(name, key, text):
        return fx.table(spark, sf_dir, name).select(
            first_line(F.col(text)), F.col(key).alias("page_id"), F.lit(name).alias("origin")
        )

    base = (
        stored("pages", "page_id", "html")
        .unionByName(stored("benchmark", "item_id", "text"))
        .groupBy("headline")
        .agg(F.min("page_id").alias("page_id"), F.min("origin").alias("origin"))
    )
    return merge.upsert(base, updates, ["headline"], ["seq"])


# Listings keyed by a code that a third of them lack.
_ISIN = "case when {key} % 3 = 0 then null else {name} || {brand} end"


@register(
    "upsert_symbols_by_isin",
    f"""with found as (
  select {_ISIN.format(key='p_partkey', name='p_name', brand='p_type')} as isin, p_partkey as seq,
    p_name as name, p_brand as code, p_size as size from part),
last as (select isin, arg_max(name, seq) as name, arg_max(code, seq) as code, arg_max(size, seq) as size
  from found group by isin),
stored as (select isin, min(country) as country, min(name) as name from (
  select {_ISIN.format(key='c_custkey', name='c_mktsegment', brand="'X'")} as isin,
    c_nationkey as country, c_name as name from customer
  union all select p_name || p_type, p_size, p_brand from part) group by isin)
select case when l.seen then l.isin else s.isin end as isin, s.country,
  case when l.seen then l.name else s.name end as name, l.code, l.size
from stored s full join (select *, true as seen from last) l on l.isin is not distinct from s.isin""",
)
def upsert_symbols_by_isin(spark, sf_dir):
    def isin(key, name, brand):
        return F.when(F.col(key) % 3 == 0, None).otherwise(F.concat(name, brand)).alias("isin")

    part = fx.table(spark, sf_dir, "part")
    updates = part.select(
        isin("p_partkey", F.col("p_name"), F.col("p_type")),
        F.col("p_partkey").alias("seq"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("code"),
        F.col("p_size").alias("size"),
    )
    stored = (
        fx.table(spark, sf_dir, "customer")
        .select(
            isin("c_custkey", F.col("c_mktsegment"), F.lit("X")),
            F.col("c_nationkey").alias("country"),
            F.col("c_name").alias("name"),
        )
        .unionByName(
            part.select(
                F.concat("p_name", "p_type").alias("isin"),
                F.col("p_size").alias("country"),
                F.col("p_brand").alias("name"),
            )
        )
        .groupBy("isin")
        .agg(F.min("country").alias("country"), F.min("name").alias("name"))
    )
    return merge.upsert(stored, updates, ["isin"], ["seq"], null_safe=True)


@register(
    "dedupe_articles",
    """select text, arg_min(source, doc_id) as source, min(doc_id) as doc_id
from documents group by text""",
)
def dedupe_articles(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("text", "doc_id", "source")
    return merge.distinct_by_key(docs, ["text"], ["doc_id"])


# --- stages -----------------------------------------------------------------


@register(
    "article_text",
    _STAGES
    + """select a.id, a.headline || '. ' || a.description || '. ' || s.summary as content
from articles a left join summaries s on s.id = a.id""",
)
def article_text(spark, sf_dir):
    joined = fx.articles(spark, sf_dir).join(fx.summaries(spark, sf_dir), "id", "left")
    return joined.select(
        "id", compose_text(F.col("headline"), F.col("description"), F.col("summary")).alias("content")
    )


@register(
    "pending_summaries",
    _STAGES
    + "select id, headline, text from articles where id not in (select id from summaries)",
)
def pending_summaries(spark, sf_dir):
    return stages.pending_summaries(fx.articles(spark, sf_dir), fx.summaries(spark, sf_dir))


@register(
    "pending_companies",
    _STAGES
    + """select a.id, a.headline, a.description, a.topic, a.topic_url_path, s.summary
from articles a join summaries s on s.id = a.id
where regexp_matches(a.topic_url_path, '^/stream') and a.id not in (select id from companies)""",
)
def pending_companies(spark, sf_dir):
    t = fx.stages(spark, sf_dir)
    return stages.pending_companies(t["articles"], t["summaries"], t["companies"])


@register(
    "pending_tickers",
    _STAGES
    + f"""select a.id, c.corp from articles a join companies c on c.id = a.id
where c.corp <> '' and {_RANGE} and a.id not in (select id from tickers)""",
)
def pending_tickers(spark, sf_dir):
    t = fx.stages(spark, sf_dir)
    return stages.pending_tickers(t["articles"], t["companies"], t["tickers"], LO, HI)


@register(
    "pending_prices",
    _STAGES
    + f"""select a.id, strftime(a.date_published, '%Y-%m-%d %H:%M:%S') as published, t.symbol, t.exchange
from articles a join tickers t on t.id = a.id where a.date_published > timestamp '{LO} 00:00:00'""",
)
def pending_prices(spark, sf_dir):
    t = fx.stages(spark, sf_dir)
    found = stages.pending_prices(t["articles"], t["tickers"], LO)
    return found.select("id", _stamp("date_published").alias("published"), "symbol", "exchange")


def _stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@register(
    "trainable_articles",
    _STAGES
    + """select a.id, a.headline, s.summary, 1 as bars from articles a
join tickers t on t.id = a.id left join summaries s on s.id = a.id where t.symbol is not null""",
)
def trainable_articles(spark, sf_dir):
    t = fx.stages(spark, sf_dir)
    bar = F.array(F.struct(F.lit("2024-01-01").alias("date"), F.lit(1.0).alias("open")))
    article_prices = t["tickers"].select(
        "id", F.when(F.col("symbol").isNotNull(), bar).alias("prices")
    )
    found = stages.trainable_articles(t["articles"], t["summaries"], article_prices)
    return found.select("id", "headline", "summary", F.size("prices").alias("bars"))


@register(
    "pending_predictions",
    _STAGES
    + f"""select a.id, a.headline, a.description, s.summary,
  strftime(a.date_published, '%Y-%m-%d %H:%M:%S') as published
from articles a left join summaries s on s.id = a.id
where {_RANGE} and a.id in (select id from tickers) and a.id not in (select id from predictions)""",
)
def pending_predictions(spark, sf_dir):
    t = fx.stages(spark, sf_dir)
    found = stages.pending_predictions(
        t["articles"], t["summaries"], t["tickers"], t["predictions"], LO, HI
    )
    return found.select(
        "id", "headline", "description", "summary", _stamp("date_published").alias("published")
    )


@register("open_date_range", _STAGES + f"select id from articles where {_RANGE}")
def open_date_range(spark, sf_dir):
    articles = fx.articles(spark, sf_dir)
    return articles.where(stages.within(F.col("date_published"), LO, HI)).select("id")


@register(
    "stream_topics",
    _STAGES + "select id, topic from articles where regexp_matches(topic_url_path, '^/stream')",
)
def stream_topics(spark, sf_dir):
    articles = fx.articles(spark, sf_dir)
    return articles.where(stages.under_path(F.col("topic_url_path"))).select("id", "topic")


@register(
    "normalize_exchange",
    f"""select o_orderkey as id, {fx._exchange_sql('o_orderkey')} as exchange,
  case when {fx._exchange_sql('o_orderkey')} = 'LSE' then 'LSE' else 'US' end as vendor_code from orders""",
)
def normalize_exchange(spark, sf_dir):
    listed = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), fx._exchange(F.col("o_orderkey")).alias("exchange")
    )
    return listed.withColumn("vendor_code", to_vendor_code(F.col("exchange")))


# --- feed -------------------------------------------------------------------

_WIDE = """wide as (
  select a.id, a.date_published, a.headline, a.description, s.summary, c.corp, t.symbol, t.exchange,
    p.prediction, p.id is not null as predicted
  from articles a left join summaries s on s.id = a.id left join companies c on c.id = a.id
  left join tickers t on t.id = a.id left join predictions p on p.id = a.id)"""
_FEED = fx.with_sql(*fx.STAGES, _WIDE) + "{select} from wide where predicted and date_published >= date '2024-01-23'"


def _feed(spark, sf_dir):
    return feed.feed_articles(**fx.stages(spark, sf_dir), as_of=AS_OF)


@register(
    "article_wide",
    fx.with_sql(*fx.STAGES, _WIDE)
    + """select id, strftime(date_published, '%Y-%m-%d %H:%M:%S') as published, headline, description,
  summary, corp, symbol, exchange, prediction from wide""",
)
def article_wide(spark, sf_dir):
    wide = feed.article_wide(**fx.stages(spark, sf_dir))
    return wide.withColumn("published", _stamp("date_published")).drop("date_published")


@register(
    "feed_articles",
    _FEED.format(
        select="""select id, strftime(date_published, '%Y-%m-%d %H:%M:%S') as published, headline,
  description, summary, corp, exchange, symbol, prediction"""
    )
    + " order by published desc, id",
)
def feed_articles(spark, sf_dir):
    found = _feed(spark, sf_dir)
    return found.withColumn("published", _stamp("date_published")).drop("date_published")


@register(
    "feed_cards",
    _FEED.format(
        select="""select id, exchange || ':' || symbol as listing,
  strftime(date_published, '%-d %b %Y, %-I:%M %p') as published, headline, description, summary,
  prediction"""
    ),
)
def feed_cards(spark, sf_dir):
    return feed.feed_cards(_feed(spark, sf_dir))


@register(
    "feed_json",
    _FEED.format(
        select="""select id, to_json({'_id': {'$oid': id::varchar},
  'date_published': {'$date': strftime(date_published, '%Y-%m-%dT%H:%M:%SZ')}, 'headline': headline,
  'description': description, 'summary': summary, 'corp': corp, 'exchange': exchange,
  'symbol': symbol, 'prediction': prediction})::varchar as json"""
    ),
)
def feed_json(spark, sf_dir):
    return feed.to_extended_json(_feed(spark, sf_dir))
