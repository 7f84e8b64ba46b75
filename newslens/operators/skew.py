"""Joins of a table with hot keys to a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    salts: int = 1,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` when one key may hold a large part of the facts.

    A lookup that was just grouped by the key is already partitioned by it. Spark
    would join in that partitioning, with all facts of a hot key in one task,
    and adaptive execution splits a task only between two shuffles made for the
    join. The salt is part of the join key, so the join gets its own shuffles and
    a hot key is split at run time. More ``salts`` also split every key up front
    at the cost of that many copies of the lookup: for sessions without adaptive
    execution. ``spread_by`` are the fact columns whose hash is the salt.
    """
    salted = facts.withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copied = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copied, [*keys, _SALT], how).drop(_SALT)
