"""Exact quantiles by counting.

Spark's exact percentile holds all distinct values of a group in one task. Here a group
is never gathered: a histogram counts its values in buckets, the bucket that holds the
wanted rank becomes the next interval, and so on until both ends of the interval are one
value. Counts are summed up before each shuffle, so a group with most of the rows costs
its tasks a few hundred numbers each.

The ends of an interval are values that occur, and have buckets of their own, so every
round makes an open interval smaller. Buckets are even on a logarithmic scale and on a
linear one in turn, so that values of any spread take few rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..sources.tables import stored

BUCKETS = 512


def _bucket(value: Column, low: Column, high: Column, logarithmic: bool) -> Column:
    """A number that does not fall while the value grows: 0 for the low end, the last
    for the high end."""
    if logarithmic:
        # The largest double has a logarithm below 710; infinity is beyond all others.
        scaled = lambda x: F.least(F.signum(x) * F.log1p(F.abs(x)), F.lit(711.0))
    else:
        scaled = lambda x: x / 2  # noqa: E731  half a difference of two doubles is finite
    share = F.try_divide(scaled(value) - scaled(low), scaled(high) - scaled(low))
    inner = F.least(F.greatest(F.floor(F.nanvl(share, F.lit(0.0)) * (BUCKETS - 2)), F.lit(0)), F.lit(BUCKETS - 3)) + 1
    return F.when(value == low, 0).when(value == high, BUCKETS - 1).otherwise(F.coalesce(inner, F.lit(1))).cast("int")


def quantiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """One row per combination of the keys, null ones too: the number of values, and a
    column for every fraction, interpolated between the two values next to it.

    Nulls and NaN are no values; a group without any has nulls. Without keys there is
    one row, also for an empty table.
    """
    names = [f"key_{i}" for i in range(max(1, len(keys)))]
    own = [C.named(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias(names[0])]
    number = C.named(value).cast("double")
    known = F.when(~F.isnan(number), number)
    rows = stored(df.select(*own, known.alias("value")), "values")
    ends = [F.count("value").alias("values"), F.min("value").alias("low"), F.max("value").alias("high")]
    groups = rows.groupBy(*names).agg(*ends) if keys else rows.agg(*ends).withColumn(names[0], F.lit(0))
    groups = stored(groups, "groups")
    # Of each fraction the places of the two values next to it, counted from 0.
    wanted = sorted({*fractions.values()})
    place = lambda f: (F.col("values") - 1) * F.lit(f)
    ranks = F.array_distinct(
        F.flatten(F.array(*[F.array(F.floor(place(f)), F.ceil(place(f))) for f in wanted]))
    )
    open_ = groups.where("values > 0").select(
        *names, "low", "high", F.lit(0).cast("bigint").alias("below"), F.explode(ranks).alias("rank")
    )
    found, logarithmic = [], True
    while True:
        open_ = stored(open_, "ranks")
        found.append(open_.where("low = high").select(*names, "rank", F.col("low").alias("value")))
        open_ = open_.where("low < high")
        if open_.isEmpty():
            break
        open_ = _narrowed(rows, open_, names, logarithmic)
        logarithmic = not logarithmic
    values = reduce(DataFrame.unionByName, found)
    by_rank = values.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    by_rank = by_rank.toDF(*[f"own_{n}" for n in names], "at")
    result = groups.join(by_rank, _same(names), "left")

    def quantile(fraction: float) -> Column:
        lower, upper = F.floor(place(fraction)), F.ceil(place(fraction))
        a, b = F.try_element_at("at", lower), F.try_element_at("at", upper)
        return F.when(lower == upper, a).otherwise(a + (b - a) * (place(fraction) - lower))

    return result.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
        "values",
        *[quantile(fraction).alias(name) for name, fraction in fractions.items()],
    )


def _same(names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"own_{n}")) for n in names])


def _narrowed(rows: DataFrame, open_: DataFrame, names: list[str], logarithmic: bool) -> DataFrame:
    """The interval of each open rank, narrowed to the bucket that holds it.

    Intervals of one group do not overlap, so a value lies in one at most, and the
    number of values below tells them apart.
    """
    intervals = open_.select(*names, "low", "high", "below").distinct()
    intervals = intervals.toDF(*[f"own_{n}" for n in names], "low", "high", "below")
    within = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    inside = rows.join(intervals, _same(names) & within)
    bucket = _bucket(F.col("value"), F.col("low"), F.col("high"), logarithmic)
    counts = inside.groupBy(*names, "below", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"), F.min("value").alias("new_low"), F.max("value").alias("new_high")
    )
    so_far = Window.partitionBy(*names, "below").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("below") + F.coalesce(F.sum("count").over(so_far), F.lit(0))
    counts = counts.withColumn("new_below", before)
    counts = counts.toDF(*[f"own_{n}" for n in names], "old_below", *counts.columns[len(names) + 1 :])
    holds = (F.col("below") == F.col("old_below")) & (F.col("rank") >= F.col("new_below"))
    holds = holds & (F.col("rank") < F.col("new_below") + F.col("count"))
    ranks = open_.select(*names, "below", "rank").join(counts, _same(names) & holds)
    return ranks.select(*names, F.col("new_low").alias("low"), F.col("new_high").alias("high"), F.col("new_below").alias("below"), "rank")
