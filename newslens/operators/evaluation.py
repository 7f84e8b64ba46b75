"""Labels, splits and scores as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens import fixed_values as fv


def label_index(labelled: DataFrame, label: str = "label") -> DataFrame:
    """``(label, rows, index)``: 0 for the most frequent label, ties by name.

    The ranking window runs over one row per label, after the aggregate.
    """
    counts = labelled.groupBy(label).agg(F.count("*").alias("rows"))
    by_rank = Window.orderBy(F.desc("rows"), F.asc(label))
    return counts.withColumn("index", (F.row_number().over(by_rank) - 1).cast("double"))


def in_training(id_col: Column, fraction: float = fv.TRAIN_FRACTION) -> Column:
    """Fixed split on the id: stable between runs, and rows of one article (ties of
    the label) stay on one side."""
    buckets = 1000
    return F.pmod(id_col * 7919 + 13, F.lit(buckets)) < int(round(fraction * buckets))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    right = (F.col(label) == F.col(prediction)).cast("double")
    return scored.agg(F.avg(right).alias("accuracy"), F.count("*").alias("rows"))


def confusion_matrix(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count("*").alias("rows"))
