"""Keyed updates from a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newslens.operators.merge import latest_per_key, upsert


def log_batches(
    rows: DataFrame, reduce: Callable[[DataFrame], DataFrame], log: str, checkpoint: str
) -> None:
    """Append the available rows to a log, each micro-batch reduced.

    A batch writes its own folder, ``query=<id>/batch_id=<n>``, and replaces it when it is
    run again: a restart neither loses nor repeats rows. A fresh checkpoint is another
    query, so it does not overwrite what an earlier one logged.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        reduce(batch).write.mode("overwrite").parquet(f"{log}/query={query}/batch_id={batch_id}")

    # An empty folder with the schema, so that the log can be read before any row.
    empty = reduce(rows.sparkSession.createDataFrame([], rows.schema))
    empty.write.mode("overwrite").parquet(f"{log}/query=none/batch_id=-1")
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log).drop("query", "batch_id")


def compact(spark: SparkSession, log: str, keys: list[str], sequence: list[str], new_log: str) -> None:
    """Fold a log to one update per key as the start of ``new_log``.

    Call it between runs and give later runs the new log with the same checkpoint. The
    sequence is kept, so an update that comes late still loses to a newer one. The old
    log is not touched: a run that fails can be repeated.
    """
    folded = latest_per_key(read_log(spark, log), keys, sequence)
    folded.write.mode("overwrite").parquet(f"{new_log}/query=folded/batch_id=-1")


def log_updates(
    updates: DataFrame, keys: list[str], sequence: list[str], log: str, checkpoint: str
) -> None:
    """Append the available updates to a log, the last per key of each micro-batch.

    The base table is not touched: a batch costs what it brings, not what is stored.
    ``sequence`` orders the updates of a key and is unique among them; of equal ones,
    which one wins is not defined.
    """
    log_batches(updates, lambda batch: latest_per_key(batch, keys, sequence), log, checkpoint)


def current(
    spark: SparkSession, base: DataFrame, log: str, keys: list[str], sequence: list[str]
) -> DataFrame:
    """The base with all logged updates applied; what one batch upsert would give."""
    return upsert(base, read_log(spark, log), keys, sequence)
