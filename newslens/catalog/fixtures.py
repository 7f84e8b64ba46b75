"""Logical tables derived from the given ones, in Spark and in SQL.

The given tables have no news, listings or prices. Each function here derives
one such table from them, whole; the SQL texts are the same recipes as
common table expressions, to be put before a checking query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.operators.prices import daily_bars
from newslens.settings import stored

# The vendor's alias codes and one that has no alias.
EXCHANGES = (*fv.US_EXCHANGES, "LSE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def _exchange(number):
    return F.element_at(
        F.array(*[F.lit(e) for e in EXCHANGES]), (number % len(EXCHANGES) + 1).cast("int")
    )


def _exchange_sql(number: str) -> str:
    codes = ", ".join(f"'{e}'" for e in EXCHANGES)
    return f"list_extract([{codes}], ({number} % {len(EXCHANGES)} + 1)::int)"


# --- listed securities ------------------------------------------------------


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One security per distinct part name."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_name").alias("name"))
        .agg(F.min("p_partkey").alias("id"))
        .select(
            "id",
            "name",
            F.concat(F.lit("P"), F.col("id").cast("string")).alias("code"),
            _exchange(F.col("id")).alias("exchange"),
        )
    )


SYMBOLS = f"""symbols as (
  select id, name, 'P' || id::varchar as code, {_exchange_sql('id')} as exchange
  from (select p_name as name, min(p_partkey) as id from part group by p_name))"""


def ticker_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company names as articles might spell them: part name and type."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("corp")
    )


TICKER_NAMES = "ticker_names as (select p_partkey as id, p_name || ' ' || p_type as corp from part)"


# --- articles with text -----------------------------------------------------


def articles(spark: SparkSession, sf_dir: str, names_first: bool = False) -> DataFrame:
    """One article per document. The headline names a security except when
    ``doc_id % 11 = 0``; the topic is the same one for half of them. With ``names_first``
    names are joined to ids before texts, which a large ``part`` then shuffles once, not twice."""
    part = table(spark, sf_dir, "part")
    n_parts = part.agg(F.count("*")).scalar()
    doc = table(spark, sf_dir, "documents")
    named = part.select(F.col("p_partkey").alias("named_key"), F.col("p_name").alias("named"))
    about = part.select(F.col("p_partkey").alias("about_key"), F.col("p_name").alias("about"))
    doc_id = F.col("doc_id")
    hours = F.make_dt_interval(days=(doc_id % 30).cast("int"), hours=(doc_id % 24).cast("int"))

    def with_names(ids: DataFrame) -> DataFrame:
        keyed = ids.withColumn("named_key", doc_id % n_parts).withColumn("about_key", (doc_id - doc_id % 2) % n_parts)
        return keyed.join(named, "named_key").join(about, "about_key")

    texts = doc.join(with_names(doc.select("doc_id").distinct()), "doc_id") if names_first else with_names(doc)
    return (
        texts.select(
            doc_id.alias("id"),
            F.concat(
                F.when(doc_id % 11 == 0, "").otherwise(F.concat("named", F.lit(": "))),
                F.split_part("text", F.lit("\n"), F.lit(1)),
            ).alias("headline"),
            F.split_part("text", F.lit("\n"), F.lit(2)).alias("description"),
            F.concat("about", F.when(doc_id % 5 == 0, " plc").otherwise("")).alias("topic"),
            F.concat(
                F.element_at(
                    F.array(F.lit("/stream/"), F.lit("/companies/"), F.lit("/letters/")),
                    (doc_id % 3 + 1).cast("int"),
                ),
                doc_id.cast("string"),
            ).alias("topic_url_path"),
            "text",
            (F.lit("2024-01-01 00:00:00").cast("timestamp") + hours).alias("date_published"),
            "source",
            "lang",
        )
    )


ARTICLES = """articles as materialized (
  select d.doc_id as id,
    case when d.doc_id % 11 = 0 then '' else named.p_name || ': ' end
      || split_part(d.text, chr(10), 1) as headline,
    split_part(d.text, chr(10), 2) as description,
    about.p_name || case when d.doc_id % 5 = 0 then ' plc' else '' end as topic,
    case d.doc_id % 3 when 0 then '/stream/' when 1 then '/companies/' else '/letters/' end
      || d.doc_id::varchar as topic_url_path,
    d.text,
    timestamp '2024-01-01 00:00:00' + to_days((d.doc_id % 30)::int)
      + to_hours(d.doc_id % 24) as date_published,
    d.source, d.lang
  from documents d
  join part named on named.p_partkey = d.doc_id % (select count(*) from part)
  join part about on about.p_partkey = (d.doc_id - d.doc_id % 2) % (select count(*) from part))"""


# --- stage tables: how far each article has come ----------------------------


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(F.col("doc_id").alias("id"), F.concat_ws(" ", "lang", "source").alias("summary"))
    )


SUMMARIES = """summaries as (
  select l.doc_id as id, d.lang || ' ' || d.source as summary
  from labels l join documents d on d.doc_id = l.doc_id)"""


def companies(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Resolved where the label says good quality; "" where it says toxic."""
    done = table(spark, sf_dir, "labels").where("quality = 1").withColumnRenamed("doc_id", "id")
    topics = (of or articles(spark, sf_dir)).select("id", "topic")
    return done.join(topics, "id").select(
        "id", F.when(F.col("toxic") == 1, "").otherwise(F.col("topic")).alias("corp")
    )


COMPANIES = """companies as materialized (
  select a.id, case when l.toxic = 1 then '' else a.topic end as corp
  from labels l join articles a on a.id = l.doc_id where l.quality = 1)"""


def tickers(
    spark: SparkSession, sf_dir: str, of: DataFrame | None = None, resolved: DataFrame | None = None
) -> DataFrame:
    """Matched where resolved and English; Spanish ones were tried without success."""
    of = of or articles(spark, sf_dir)
    tried = of.where(F.col("lang").isin("en", "es")).select("id", "lang")
    found = F.col("lang") == "en"
    return (
        (resolved or companies(spark, sf_dir, of))
        .where("corp <> ''")
        .join(tried, "id")
        .select(
            "id",
            F.when(found, F.concat(F.lit("P"), F.col("id").cast("string"))).alias("symbol"),
            F.when(found, _exchange(F.col("id"))).alias("exchange"),
        )
    )


TICKERS = f"""tickers as materialized (
  select c.id, case when a.lang = 'en' then 'P' || c.id::varchar end as symbol,
    case when a.lang = 'en' then {_exchange_sql('c.id')} end as exchange
  from companies c join articles a on a.id = c.id
  where c.corp <> '' and a.lang in ('en', 'es'))"""


def predictions(spark: SparkSession, sf_dir: str, matched: DataFrame | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return (
        (matched or tickers(spark, sf_dir))
        .where("symbol is not null")
        .join(docs, "id")
        .where("n_chars > 1000")
        .select("id", F.when(F.col("n_chars") % 2 == 0, fv.RISE).otherwise(fv.FALL).alias("prediction"))
    )


PREDICTIONS = """predictions as (
  select t.id, case when d.n_chars % 2 = 0 then 'rise' else 'fall' end as prediction
  from tickers t join documents d on d.doc_id = t.id
  where t.symbol is not null and d.n_chars > 1000)"""

STAGES = (ARTICLES, SUMMARIES, COMPANIES, TICKERS, PREDICTIONS)


def stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All stage tables, each written once and read by the next."""
    written = stored(articles(spark, sf_dir), "articles")
    resolved = stored(companies(spark, sf_dir, written), "companies")
    matched = stored(tickers(spark, sf_dir, written, resolved), "tickers")
    return {
        "articles": written,
        "summaries": summaries(spark, sf_dir),
        "companies": resolved,
        "tickers": matched,
        "predictions": predictions(spark, sf_dir, matched),
    }


# --- prices -----------------------------------------------------------------


def priced_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_tickers = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % n_tickers).alias("ticker"),
        F.to_date("o_orderdate").alias("date_published"),
    )


PRICED_ARTICLES = """priced_articles as (
  select o_orderkey as id, o_custkey % (select count(*) from supplier) as ticker,
    o_orderdate::date as date_published from orders)"""


def trade_order():
    """Trades are ordered by line; repeated line numbers by price, which has less than
    2^24 cents. The order is one long, which keeps the aggregate hash-based (a struct
    would make it sort)."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * (1 << 24) + cents


def price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with every line item as a trade of its supplier."""
    return daily_bars(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        F.col("l_shipdate"),
        "l_extendedprice",
        trade_order(),
        F.col("l_quantity").cast("long"),
    )


def news_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the listed securities in the two months from the first article on,
    with every line item as a trade of its part."""
    day = F.date_add(
        F.lit("2024-01-01").cast("date"),
        F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")) % 60,
    )
    traded = table(spark, sf_dir, "lineitem").withColumn(
        "code", F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    )
    return daily_bars(
        traded, "code", day, "l_extendedprice", trade_order(), F.col("l_quantity").cast("long")
    ).select("ticker", "date", "open", "adjusted_close")


def label_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar fields that labels need; the others are never computed."""
    return price_bars(spark, sf_dir).select("ticker", "date", "open", "adjusted_close")


_TRADE_ORDER = """(l_orderkey * 10 + l_linenumber) * 16777216
    + round(l_extendedprice * 100)::bigint"""

NEWS_BARS = f"""bars as (
  select 'P' || l_partkey::varchar as ticker,
    date '2024-01-01' + (l_shipdate::date - date '1992-01-01')::int % 60 as date,
    arg_min(l_extendedprice, ord) as open, arg_max(l_extendedprice, ord) as adjusted_close
  from (select *, {_TRADE_ORDER} as ord from lineitem) group by 1, 2)"""

PRICE_BARS = f"""bars as (
  select l_suppkey as ticker, l_shipdate::date as date,
    arg_min(l_extendedprice, ord) as open,
    max(l_extendedprice) as high, min(l_extendedprice) as low,
    arg_max(l_extendedprice, ord) as close,
    arg_max(l_extendedprice, ord) as adjusted_close,
    sum(l_quantity::bigint)::bigint as volume
  from (select *, {_TRADE_ORDER} as ord from lineitem) group by 1, 2)"""

# Each article with each bar of its window; md is the least distance to a week on.
WINDOWED = """windowed as (
  select a.id, a.ticker, a.date_published, b.date, b.open, b.adjusted_close,
    abs(b.date - (a.date_published + 7)) as dist,
    min(abs(b.date - (a.date_published + 7))) over (partition by a.id) as md,
    arg_min(b.open, b.date) over (partition by a.id) as current_open
  from priced_articles a
  join bars b on b.ticker = a.ticker and b.date between a.date_published and a.date_published + 28)"""


# --- a rule as a stand-in model ---------------------------------------------


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            F.col("quality").alias("label"),
            (F.col("n_chars") > 500).cast("int").alias("prediction"),
        )
    )


RULE_PREDICTIONS = """rule_predictions as (
  select l.doc_id as id, l.quality as label, (d.n_chars > 500)::int as prediction
  from labels l join documents d on d.doc_id = l.doc_id)"""
