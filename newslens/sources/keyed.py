"""Stage tables dealt to folders by a hash of their key, so that an update rewrites only the folders it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.operators.merge import latest_per_key, partial_update
from newslens.settings import stored

PART = "__part"


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table at ``path`` in ``parts`` folders. ``parts`` is chosen once, for folders of a few files each."""

    spark: SparkSession
    path: str
    keys: list[str]
    parts: int

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def _write(self, rows: DataFrame) -> None:
        dealt = rows.withColumn(PART, self._part()).repartition(PART)
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART)
            .parquet(self.path)
        )

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], parts: int) -> "KeyedTable":
        table = cls(rows.sparkSession, path, keys, parts)
        table._write(rows)
        return table

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(PART)

    def touched(self, updates: DataFrame) -> list[int]:
        """The folders that rows of these keys are in: ``parts`` numbers at most."""
        return sorted(r[0] for r in updates.select(self._part()).distinct().collect())

    def update(self, updates: DataFrame, insert: bool = True, sequence: list[str] | None = None) -> list[int]:
        """:func:`partial_update` in place; the folders that were written.

        Folders without an update are neither read nor written. The new rows are written apart
        before any folder is replaced, so a run that fails can be repeated: applying an update twice
        equals once. ``sequence`` orders updates that share a key, the last one winning.
        """
        if sequence:
            last = latest_per_key(updates, self.keys, sequence)
            updates = last.drop(*[c for c in sequence if c not in self.keys and c not in self.read().columns])
        updates = stored(updates, "updates")
        parts = self.touched(updates)
        if not parts:
            return []
        base = self.spark.read.parquet(self.path).where(F.col(PART).isin(parts)).drop(PART)
        merged = partial_update(base, updates, self.keys, insert)
        self._write(stored(merged.select(*base.columns), "merged"))
        return parts
