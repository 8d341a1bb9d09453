"""Exact sums.

A sum of doubles depends on the order of its rows, which differs from run to run
on a cluster. Money and weights have few decimals, so they are summed as decimals
and only the total is a double. 28 digits hold any amount, and 38 its sum. A number that they do not hold
is added as a double: it neither ends the query nor is left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(column: Column, scale: int = 2) -> Column:
    large = F.abs(column) >= F.lit(10.0 ** (28 - scale))
    within = F.sum(column.try_cast(f"decimal(28,{scale})")).cast("double")
    beyond = F.sum(F.when(large, column.cast("double")))
    return F.coalesce(within + beyond, within, beyond)


def mean(column: Column, scale: int = 2) -> Column:
    """Total over the number of non-null values; null if there are none."""
    return total(column, scale) / F.count(column)
