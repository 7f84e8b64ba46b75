"""Small Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Catalyst inlines a projected expression into a later lambda, where it would
    run once per array element. Binding it as a lambda variable prevents that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda acc, x: acc + x)


def running_starts(lengths: Column, least_block: int = 8) -> Column:
    """Exclusive prefix sums of an int array.

    Sums run over blocks first. With blocks of about the cube root of ``n`` the
    work per row is about ``n ** (4 / 3)``; appending to one accumulator would
    copy ``n * n`` values.
    """

    def with_block(lens: Column, block: Column) -> Column:
        n_blocks = F.ceil(F.size(lens) / block).cast("int")
        block_sums = F.transform(
            F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))),
            lambda b: total(F.slice(lens, b * block + 1, block), F.lit(0)),
        )
        block_starts = F.aggregate(
            block_sums,
            F.array(F.lit(0)),
            lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)),
        )
        return let(
            block_starts,
            lambda bs: F.transform(
                lens,
                lambda _, i: F.get(bs, F.floor(i / block).cast("int"))
                + total(F.slice(lens, i - i % block + 1, i % block), F.lit(0)),
            ),
        )

    def starts(lens: Column) -> Column:
        root = F.greatest(F.ceil(F.cbrt(F.size(lens))).cast("int"), F.lit(least_block))
        return let(root, lambda block: with_block(lens, block))

    return let(lengths, starts)
