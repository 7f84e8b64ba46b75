"""Job settings and the shared folder for intermediate tables."""

from __future__ import annotations

import json
import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from newslens import fixed_values as fv


@dataclass(frozen=True)
class JobSettings:
    """Arguments of the scheduled jobs. Plain values, no globals."""

    max_distance: float = fv.DEFAULT_MAX_DISTANCE
    company_threshold: int = fv.COMPANY_SIMILARITY_THRESHOLD
    min_length: int = fv.SUMMARY_MIN_LENGTH
    max_length: int = fv.SUMMARY_MAX_LENGTH
    boosting_rounds: int = fv.BOOSTING_ROUNDS

    @classmethod
    def from_json_files(cls, *paths: str) -> "JobSettings":
        """Merge JSON config files; unknown keys are an error, not ignored."""
        merged: dict = {}
        for path in paths:
            merged.update(json.loads(Path(path).read_text()))
        return cls(**merged)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach, below ``spark.checkpoint.dir``.

    A session without that setting gets a folder of its own once, for local runs only:
    on a cluster the shared folder must be named.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="newslens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/newslens-{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers that were started elsewhere, or on another machine, can then import it.
    """
    context = spark.sparkContext
    if getattr(context, "_newslens_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="newslens-package-")) / "newslens.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    context._newslens_shipped = True


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several passes read; a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
