"""Operator 5: shards of nearly equal bytes by sampled splitters.

1. Keys (hash of the text, doc_id) are sampled, a record with a probability in
   proportion to its size, so that sampled keys stand for equal numbers of bytes.
2. Quantiles of the sample are the boundaries of key ranges, ``RANGES`` for each shard.
   A boundary inside a group of equal texts moves to the group's start, unless the
   group alone is larger than a shard: only such a group is divided, by doc_id.
3. Bytes of each range are then counted exactly. Overfull ranges get a sample and
   boundaries of their own, in up to ``ROUNDS`` rounds.
4. Ranges, the largest first, go to the shard that has the fewest bytes so far. A
   record's slot is its place in its range plus the records of the shard's ranges before.

The driver sees the sample and one row per range, both of fixed size, whatever the
input. Only keys and sizes are shuffled, never texts.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

SHARDS = 24
#: Ranges per shard, and sampled keys per range; both bound what the driver sees.
RANGES, SAMPLED = 64, 16
#: A range with more than so many times its share is overfull.
OVERFULL = 2.0
#: Bytes that a record takes besides its text.
RECORD = 8
#: Rounds in which overfull ranges are divided, at most.
ROUNDS = 4
FIRST = -(1 << 63)

Key = tuple[int, int]


def sized(df: DataFrame, text: str = "text") -> DataFrame:
    """Add size (UTF-8 bytes and ``RECORD``; none for a null text) and text_crc32."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {"size": (F.octet_length(whole) + RECORD).cast("bigint"), "text_crc32": F.crc32(whole.cast("binary"))}
    )


def _sample(keys: DataFrame, wanted: int, total: int, seed: int) -> list[tuple[int, int, float]]:
    """Sorted (group, id, bytes that it stands for); about ``wanted``, by a hash."""
    chance = F.col("size") * F.lit(wanted / total)
    drawn = F.pmod(F.xxhash64("group__", "id__", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = keys.where(drawn < chance).select("group__", "id__", "size").collect()
    return sorted((r.group__, r.id__, max(float(r.size), total / wanted)) for r in rows)


def _larger_than_a_shard(keys: DataFrame, sample: list[tuple[int, int, float]], shard: float) -> set[int]:
    """Groups of equal texts that no shard holds. Those that the sample gives half a
    shard, a few for each shard at most, are counted exactly."""
    weight: dict[int, float] = {}
    for group, _, size in sample:
        weight[group] = weight.get(group, 0.0) + size
    heavy = [group for group, size in weight.items() if size > shard / 2]
    if not heavy:
        return set()
    exact = keys.where(F.col("group__").isin(heavy)).groupBy("group__").agg(F.sum("size").alias("size"))
    return {row.group__ for row in exact.where(F.col("size") > shard).collect()}


def _boundaries(sample: list[tuple[int, int, float]], parts: int, divided: set[int]) -> list[Key]:
    """Keys at equal steps of sampled bytes, at group starts but in ``divided`` groups."""
    if not sample or parts < 2:
        return []
    running = np.cumsum([x[2] for x in sample])
    share = running[-1] / parts
    found = set()
    for step in range(1, parts):
        group, own, _ = sample[int(np.searchsorted(running, step * share))]
        found.add((group, own if group in divided else FIRST))
    return sorted(found)


def _with_range(keys: DataFrame, boundaries: list[Key]) -> DataFrame:
    """Add the number of the range of (group__, id__), by binary search."""
    groups = np.array([b[0] for b in boundaries], np.int64)
    ids = np.array([b[1] for b in boundaries], np.int64)

    @F.pandas_udf("int")
    def place(group: pd.Series, own: pd.Series) -> pd.Series:
        low = np.searchsorted(groups, group.to_numpy(), "left")
        high = np.searchsorted(groups, group.to_numpy(), "right")
        found = low.astype(np.int64)
        for at in np.flatnonzero(high > low):
            inside = ids[low[at] : high[at]]
            found[at] += np.searchsorted(inside, own.iat[at], "right")
        return pd.Series(found.astype(np.int32))

    return keys.withColumn("range__", place("group__", "id__"))


def _ranges(keys: DataFrame, shards: int) -> tuple[list[Key], dict[int, tuple[int, int]]]:
    """Boundaries, and (bytes, records) by range."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = shards * RANGES
    sample = _sample(keys, parts * SAMPLED, total, 0) if total else []
    divided = _larger_than_a_shard(keys, sample, total / shards)
    boundaries = _boundaries(sample, parts, divided)
    for seed in range(1, ROUNDS + 1):
        counted = _with_range(keys, boundaries).groupBy("range__").agg(F.sum("size"), F.count("*"), F.max("size"))
        rows = {r[0]: r[1:] for r in counted.collect()}
        full = {r: x[0] for r, x in rows.items() if x[0] > OVERFULL * total / parts and x[0] > 2 * x[2]}
        if not full or seed == ROUNDS:
            break
        inside = _with_range(keys, boundaries).where(F.col("range__").isin(list(full)))
        drawn = _sample(inside, min(parts, len(full) * 4) * SAMPLED, sum(full.values()), seed)
        more = set(boundaries)
        for r, size in full.items():
            low = bisect_left(drawn, (*boundaries[r - 1], 0.0)) if r else 0
            high = bisect_left(drawn, (*boundaries[r], 0.0)) if r < len(boundaries) else len(drawn)
            more |= set(_boundaries(drawn[low:high], int(np.ceil(size * parts / total)), divided))
        if more == set(boundaries):
            break
        boundaries = sorted(more)
    return boundaries, {r: (x[0], x[1]) for r, x in rows.items()}


def shard(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add size, text_crc32, shard (0 to shards - 1) and slot (gapless in its shard).

    Shards hold nearly equal bytes; they differ by a range (1/64 of a shard), or by one
    record or group of equal texts that is larger. Equal texts are in one shard, unless
    they are larger than a shard, when they are divided by key. Slots follow (hash of the text, key); rows
    that are equal in both, and without a key, get their slots in any order. Columns
    of these names are replaced. ``keep_text=False`` leaves the text out, so that only
    keys are shuffled. An empty table gives an empty one.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = sized(df.drop("size", "text_crc32", "shard", "slot"), text)
    rows = rows.withColumns({"group__": F.xxhash64(whole), "id__": F.coalesce(F.col(key).cast("bigint"), F.lit(FIRST))})
    if keep_text:
        keys = stored(rows.select("group__", "id__", "size"), "shard-keys")
    else:
        keys = rows = stored(rows.drop(text), "shard-keys")
    boundaries, counted = _ranges(keys, shards)
    table = _placed(counted, shards)
    by_range = df.sparkSession.createDataFrame(table, "range__ int, shard int, before__ bigint")
    order = Window.partitionBy("range__").orderBy("group__", "id__")
    placed = _with_range(rows, boundaries).withColumn("place__", F.row_number().over(order))
    # one row per range: their number is fixed by the parameters
    placed = placed.join(F.broadcast(by_range), "range__")
    slot = (F.col("before__") + F.col("place__") - 1).cast("bigint")
    return placed.withColumn("slot", slot).drop("group__", "id__", "range__", "place__", "before__")


def _placed(counted: dict[int, tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(range, shard, records of the shard before it)."""
    filled = [(0, number) for number in range(shards)]
    place = {}
    for number in sorted(counted, key=lambda r: (-counted[r][0], r)):
        size, place[number] = heapq.heappop(filled)
        heapq.heappush(filled, (size + counted[number][0], place[number]))
    records, table = [0] * shards, []
    for number in sorted(counted):
        table.append((number, place[number], records[place[number]]))
        records[place[number]] += counted[number][1]
    return table
