"""Sums and several distinct counts by two levels.

Spark plans several distinct counts by an Expand: every line once more for each. Here
the lines are summed up once by the finest key, all columns that are grouped by or
counted together, and written. Everything else is rolled up from these rows: sums again
as sums, and each distinct count from the distinct pairs of key and value. Several
marts can share the same rows, and a hot key is spread over the values that it meets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..sources.tables import stored

ROWS = "rows__"


def _parts(name: str) -> tuple[str, str, str]:
    return f"{name}__exact", f"{name}__beyond", f"{name}__values"


def pre_aggregate(lines: DataFrame, keys: list[Column], **amounts: tuple[Column, int]) -> DataFrame:
    """One row per combination of the keys: its lines, and of each amount, given with the
    number of its decimals, the exact sum, that of numbers which no decimal holds, and the
    number of values."""
    sums = [F.count(F.lit(1)).alias(ROWS)]
    for name, (value, scale) in amounts.items():
        exact, beyond, values = _parts(name)
        sums += [
            F.sum(value.try_cast(f"decimal(28,{scale})")).alias(exact),
            F.sum(F.when(F.abs(value) >= F.lit(10.0 ** (28 - scale)), value.cast("double"))).alias(beyond),
            F.count(value).alias(values),
        ]
    return stored(lines.groupBy(*keys).agg(*sums), "pre-aggregate")


def rows() -> Column:
    return F.coalesce(F.sum(ROWS), F.lit(0))


def total(name: str) -> Column:
    """As ``totals.total`` over the lines."""
    exact, beyond, _ = _parts(name)
    within, more = F.sum(exact).cast("double"), F.sum(beyond)
    return F.coalesce(within + more, within, more)


def mean(name: str) -> Column:
    """As ``totals.mean`` over the lines."""
    return F.try_divide(total(name), F.sum(_parts(name)[2]))


def rolled_up(pre: DataFrame, keys: tuple[str, ...], sums: dict[str, Column], distinct: dict[str, str]) -> DataFrame:
    """One row per combination of fewer keys, none for one row in all: ``sums``, and the
    number of distinct values, nulls left out, of the columns in ``distinct``.

    Sums and values of each column are rows of one kind each. One exchange by key, kind
    and value brings equal values together, a second one the short rows of each key.
    """
    own = [C.named(key) for key in keys]
    added = [name for name in pre.columns if name == ROWS or name.endswith(("__exact", "__beyond", "__values"))]
    kinds = [pre.select(*own, F.lit(0).alias("kind__"), F.lit(None).cast("string").alias("value__"), *added)]
    for number, column in enumerate(distinct.values(), 1):
        value = C.named(column).cast("string").alias("value__")
        kinds.append(pre.select(*own, F.lit(number).alias("kind__"), value))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
    single = together.groupBy(*own, "kind__", "value__").agg(*[F.sum(name).alias(name) for name in added])
    counts = [
        F.count(F.when(F.col("kind__") == number, F.col("value__"))).alias(name) for number, name in enumerate(distinct, 1)
    ]
    return single.groupBy(*own).agg(*[value.alias(name) for name, value in sums.items()], *counts)
