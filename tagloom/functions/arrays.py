"""Array helpers built from Spark's higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable.

    Naming an expression with ``withColumn`` is not enough when a lambda uses it: the optimizer may
    inline the expression into the lambda, where it would be recomputed for every element.
    """
    return F.transform(F.array(value), body)[0]


def _running(values: Column) -> Column:
    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("sums"))

    def step(acc: Column, x: Column) -> Column:
        total = acc.total + x
        return F.struct(total.alias("total"), F.array_append(acc.sums, total).alias("sums"))

    return F.aggregate(values, start, step)


def running_total(values: Column, block: int = 64) -> Column:
    """Inclusive prefix sums of an int array.

    Appending to an array copies it, so one fold over ``n`` values costs n² copies. Folding blocks of
    ``block`` values and then the block totals costs ``n * block + (n / block)²``, which keeps a
    100,000-token sentence cheap without leaving the row (no explode, window or shuffle).
    """

    def blocks(v: Column) -> Column:
        heads = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(block))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(heads, lambda h: _running(F.slice(v, h, F.lit(block))))

    def shift(parts: Column) -> Column:
        totals = _running(F.transform(parts, lambda p: p.total)).sums
        return let(
            totals,
            lambda base: F.flatten(
                F.transform(
                    parts,
                    lambda p, i: F.transform(p.sums, lambda x: x + F.coalesce(F.get(base, i - 1), F.lit(0))),
                )
            ),
        )

    return let(values, lambda v: let(blocks(v), shift))


def strings(*cols: Column) -> Column:
    """The non-null columns as one array, in order."""
    return F.array_compact(F.array(*cols))


def exploded(rows: DataFrame, keep: list[str], array: Column, name: str, at: str | None = None) -> DataFrame:
    """``keep`` and one row per element of ``array`` as ``name``, with its place ``at`` where one is named.

    Before a plain ``explode`` the optimizer tests that the array is not empty, for which a computed array is computed once more.
    """
    place = at or "_at"
    out = rows.select(*keep, F.posexplode_outer(array).alias(place, name)).filter(F.col(place).isNotNull())
    return out if at else out.drop(place)


def empty_strings() -> Column:
    return F.array().cast("array<string>")
