"""Listed securities from landed vendor responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import schemas


def read_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of JSON files, each an array of records; read file-parallel."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_responses(responses: DataFrame, body: str, schema: T.StructType, *keep: str) -> DataFrame:
    """A column of response bodies, each a JSON array, to one row per record."""
    records = F.from_json(F.col(body), T.ArrayType(schema))
    return responses.select(*keep, F.explode(records).alias("record"))


def lower_keys(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def exchange_codes(responses: DataFrame, body: str) -> DataFrame:
    """Codes listed by the exchange-list responses; each one is a symbol-list request."""
    return parse_responses(responses, body, schemas.VENDOR_EXCHANGE).select(
        F.col("record.Code").alias("code")
    )


def symbols_from_json(
    exchange_lists: DataFrame, symbol_lists: DataFrame, exchange: str, body: str
) -> DataFrame:
    """Symbols of every listed exchange.

    ``symbol_lists`` has one row per landed response with the exchange it was
    asked for. Responses for exchanges that are not listed are left out.
    """
    listed = exchange_codes(exchange_lists, body).distinct()
    wanted = symbol_lists.join(
        listed.withColumnRenamed("code", exchange), exchange, "left_semi"
    )
    records = parse_responses(wanted, body, schemas.VENDOR_SYMBOL)
    return lower_keys(records.select("record.*"))


def symbol_list_request(exchange: Column, delisted: Column) -> Column:
    """Query part of the symbol-list request; the token is added by the caller."""
    return F.concat(
        F.lit("exchange-symbol-list/"), exchange, F.lit("?fmt=json&delisted="), delisted
    )
