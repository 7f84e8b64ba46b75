"""Columnar table scans with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from newslens import schemas


def scan(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """Read Parquet without inference. Column choice and later ``where`` calls
    reach the scan as ``ReadSchema`` and ``PushedFilters``."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def articles(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return scan(spark, path, schemas.ARTICLES, columns)


def symbols(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.SYMBOLS, ["id", "name", "code", "exchange"])


def price_bars(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.PRICE_BARS)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Write a stage table bucketed and sorted by its key.

    Stage tables saved with the same key and bucket count join and anti-join
    without a shuffle.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
