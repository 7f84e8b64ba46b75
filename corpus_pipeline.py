"""A corpus pipeline of five of the operators, each stage written and read again before the next.

1. language: documents that no language model accepts go.
2. near_copies: one document of each group of near copies stays.
3. decontaminate: documents that the contamination rule marks go.
4. secrets: secrets are masked in the texts that stay, and n_chars put right.
5. pieces: texts as piece ids (column ``ids``), with their number.

Each stage learns from or counts over all documents that it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import decontaminate, jaccard_join, langid, piece_codec, secret_scan
from newslens.settings import stored

ORACLE_SQL = None  # SQL can't express the language models, the Markov models and the piece search


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.drop_rejected(docs, langid.train(docs.where(~langid.held_out())))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, secret_scan.train(secret_scan.labelled_samples(docs)))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminate", decontaminated),
    ("secrets", secrets),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
