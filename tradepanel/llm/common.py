"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A column that a lambda refers to is computed anew for every element; bound as
    the element of an array of one, it is computed once.
    """
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each value combined with all before it, by steps of doubled reach."""
    reach = F.transform(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int")),
        lambda k: F.call_function("shiftleft", F.lit(1), k),
    )
    return F.aggregate(
        reach,
        values,
        lambda so_far, step: F.transform(
            so_far, lambda x, i: F.when(i >= step, combine(x, F.get(so_far, i - step))).otherwise(x)
        ),
    )


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read by the driver; it is sent to tasks as a broadcast."""
    return Path(path).read_bytes()


def marked_present(df: DataFrame, key: str, ids: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """Add ``maybe__``: false only for rows whose key is none of ``ids`` (one column).

    A bitmap with about eight bits per id, at most ``most_bits``, is joined by a
    broadcast of bounded size (64 bits a row). A full bitmap marks every row: it spares
    a shuffle of rows that have no partner and decides nothing.
    """
    name = ids.columns[0]
    bits = min(most_bits, 1 << max(10, (8 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64(F.col(name).cast("bigint")), F.lit(bits))
    own = ids.select(F.shiftright(place, 6).alias("word__"), F.expr("1L").alias("one"), place.alias("place"))
    words = own.select("word__", F.call_function("shiftleft", F.col("one"), (F.col("place") % 64).cast("int")).alias("bit"))
    words = words.groupBy("word__").agg(F.bit_or("bit").alias("bits__"))
    place = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(bits))
    marked = df.withColumns({"word__": F.shiftright(place, 6), "place__": (place % 64).cast("int")})
    marked = marked.join(F.broadcast(words), "word__", "left")
    there = F.call_function("getbit", F.coalesce("bits__", F.lit(0).cast("bigint")), F.col("place__")) == 1
    return marked.withColumn("maybe__", there).drop("word__", "place__", "bits__")


class Bounded(dict):
    """A table of computed values that starts anew when it holds ``limit`` of them."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class BoundedBytes(dict):
    """A table of computed values in about ``limit`` bytes, as ``weigh`` estimates them
    from a key and its value.

    Values that half the limit holds are the young ones; when there are more, they become
    the old ones, and those that were old go. A value that is used again while it is old
    is young again, so what is used often stays.
    """

    def __init__(self, compute: Callable, limit: int, weigh: Callable):
        super().__init__()
        self.compute, self.limit, self.weigh = compute, limit, weigh
        self.old, self.held = {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        size = self.weigh(key, value)
        if self.held + size > self.limit / 2:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += size
        return value
