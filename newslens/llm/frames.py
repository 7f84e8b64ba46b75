"""Carrying a table's own columns through an operator without name clashes.

Operators work on two columns, ``row`` (a struct of whatever is kept) and ``text``, so no
column of the input can clash with one that they add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def pack(docs: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the kept columns but the text) and ``text``."""
    keep = docs.columns if keep is None else keep
    own = [F.col(quoted(c)) for c in keep if c != text] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*own).alias("row"), F.col(quoted(text)).cast("string").alias("text"))


def unpack(packed: DataFrame, text: str, keep: list[str], /, **added: Column) -> DataFrame:
    """The kept columns in their order, then the added ones; an added name replaces a kept one."""
    own = [F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in keep if c not in added]
    return packed.select(*own, *[c.alias(name) for name, c in added.items()])
