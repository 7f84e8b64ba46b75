"""Table schemas, stated once. Reads never infer a schema."""

from pyspark.sql import types as T

BAR = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adjusted_close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("headline", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("topic_url_path", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("date_published", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)

SYMBOLS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("isin", T.StringType()),
    ]
)

PRICE_BARS = T.StructType([T.StructField("ticker", T.StringType()), *BAR.fields])

ENTITY = T.StructType(
    [
        T.StructField("entity_group", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("word", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)

# Vendor responses keep the vendor's spelling of the keys.
VENDOR_EXCHANGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("Name", "Code", "Country", "Currency")]
)
VENDOR_SYMBOL = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("Code", "Name", "Country", "Exchange", "Currency", "Type", "Isin")
    ]
)

# The two JSON-LD blocks of an article page.
LD_ARTICLE = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("headline", "description", "articleBody", "datePublished")
    ]
)
LD_BREADCRUMBS = T.StructType(
    [
        T.StructField(
            "itemListElement",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("item", T.StringType())]
                )
            ),
        )
    ]
)
