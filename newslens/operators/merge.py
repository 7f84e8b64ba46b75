"""Keyed writes: partial update, upsert, update without insert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "__in_update"


def latest_per_key(updates: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The last update of each key by ``sequence``.

    An aggregate and not a window: it combines before the shuffle, so a key with
    a third of all updates leaves each map task as one row. NULL keys are one key.
    """
    rest = [c for c in updates.columns if c not in keys]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("last"))
        .select(*keys, "last.*")
    )


def _same_key(keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"b.{k}"), F.col(f"u.{k}")) for k in keys]
    return reduce(
        lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs]
    )


def partial_update(
    base: DataFrame,
    updates: DataFrame,
    keys: list[str],
    insert: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Write the update's columns onto the base rows with the same key.

    A NULL in the update overwrites; columns the update lacks keep their value.
    Both sides hold a key at most once (see :func:`latest_per_key`). With
    ``insert=False`` unmatched updates are ignored. Running it twice equals once.
    """
    marked = updates.withColumn(_HIT, F.lit(True))
    joined = base.alias("b").join(
        marked.alias("u"), _same_key(keys, null_safe), "full" if insert else "left"
    )
    hit = F.col(f"u.{_HIT}").isNotNull()
    columns = []
    for name in base.columns:
        if name in updates.columns:
            columns.append(
                F.when(hit, F.col(f"u.{name}")).otherwise(F.col(f"b.{name}")).alias(name)
            )
        else:
            columns.append(F.col(f"b.{name}"))
    added = [F.col(f"u.{c}").alias(c) for c in updates.columns if c not in base.columns]
    return joined.select(*columns, *added)


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: list[str],
    sequence: list[str],
    null_safe: bool = False,
    insert: bool = True,
) -> DataFrame:
    """Apply updates in ``sequence`` order, the last one winning; new keys are added.

    With ``null_safe`` all rows without a key are one row, as in a store that
    matches NULL with NULL.
    """
    last = latest_per_key(updates, keys, sequence)
    helper = [c for c in sequence if c not in base.columns and c not in keys]
    return partial_update(base, last.drop(*helper), keys, insert, null_safe)


def distinct_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``; deterministic duplicate removal."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
        .select(*keys, "first.*")
    )
