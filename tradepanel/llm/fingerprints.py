"""Operator 1: document fingerprints as bottom-k sketches of shingle hashes.

A sketch is the ascending list of the ``K`` smallest distinct 64-bit hashes of a
text's shingles (five words; fewer words are one shingle). Sketches merge by taking
the smallest of both, so parts of a document, or documents of a source, can be
sketched apart. From sketches alone follow resemblance, containment and the number
of distinct shingles, exactly while all hashes fit in.

Everything is column expressions on the JVM. To find each document's successor, rows
are dealt into ranges of doc_id by sampled quantiles, and every range gets a copy of
the first row of the next one: one shuffle of the texts, no global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

K = 128
SHINGLE = 5
#: Ranges of doc_id per shuffle partition.
RANGES = 4
FIRST = -(1 << 63)


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles, repeated ones too; none for a text without words."""

    def of_hashes(h: Column) -> Column:
        each = F.transform(
            F.slice(h, 1, F.size(h) - (size - 1)),
            lambda first, i: F.xxhash64(first, *[F.get(h, i + k) for k in range(1, size)]),
        )
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= size, each).otherwise(whole)

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of_hashes)


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text; empty for a null text or one without words."""
    return bottom(shingle_hashes(F.coalesce(text, F.lit("")), size), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return bottom(F.concat(a, b), k)


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group, of any number of rows.

    Equal hashes are one row before the shuffle, and only the k smallest of a group
    leave a task. A group of empty sketches gives an empty one.
    """
    smallest = Window.partitionBy(*by).orderBy("hash__")
    hashes = sketches.select(*by, F.explode(column).alias("hash__")).distinct()
    ranked = hashes.withColumn("rank__", F.row_number().over(smallest)).where(F.col("rank__") <= k)
    found = ranked.groupBy(*by).agg(F.sort_array(F.collect_list("hash__")).alias(column))
    same = [F.col(f"left__.{c}").eqNullSafe(F.col(f"right__.{c}")) for c in by]
    groups = sketches.select(*by).distinct().alias("left__")
    joined = groups.join(found.alias("right__"), same, "left")
    empty = F.array().cast("array<bigint>")
    return joined.select(*[F.col(f"left__.{c}") for c in by], F.coalesce(F.col(f"right__.{column}"), empty).alias(column))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = (F.element_at(s, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / largest)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B|, 0 to 1; two empty sketches are alike (1)."""

    def of_union(union: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(a, b), union))
        return F.when(F.size(union) > 0, common / F.size(union)).otherwise(F.lit(1.0))

    return let(merge(a, b, k), of_union)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B has; 1 for an empty A."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.lower(F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at most the key, by halving steps."""
    if not splitters:
        return F.lit(0)
    step = 1 << (len(splitters).bit_length() - 1)
    steps = []
    while step:
        steps.append(step)
        step //= 2
    table = F.array(*map(F.lit, splitters)) if len(splitters) < 2 else F.lit(splitters)

    def forward(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(table, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(F.lit(steps) if len(steps) > 1 else F.array(F.lit(steps[0])), F.lit(0), forward)


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Window]:
    """Documents with ``next_text``, and a copy of each range's successor (``copy__``).

    The order is doc_id (null first) and then a hash of the text; the last is followed
    by the first. Also gives the window, within which rows are in that order.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(FIRST))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    found = docs.select(key.alias("key")).agg(F.percentile_approx("key", steps, 100 * ranges)).first()[0]
    splitters = sorted(set(found or ()))
    rows = docs.withColumns({"key__": key, "tie__": F.xxhash64(text)}).withColumn("range__", _range_of(F.col("key__"), splitters))
    # one row per range: as many as the session's setting says
    heads = rows.groupBy("range__").agg(F.min("key__")).collect()
    heads = sorted((r[0], r[1]) for r in heads)
    before = [(head, heads[at - 1][0]) for at, (_, head) in enumerate(heads)]
    copies = rows.drop("range__").join(F.broadcast(spark.createDataFrame(before, "key__ bigint, range__ int")), "key__")
    both = rows.withColumn("copy__", F.lit(False)).unionByName(copies.withColumn("copy__", F.lit(True)))
    order = Window.partitionBy("range__").orderBy("copy__", "key__", "tie__")
    return both.withColumn("next_text", F.lead(text).over(order)), order


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Sketches of each text and of its edited text, and their likeness.

    The edited text has its last quarter replaced by as much of the next document's
    start. A null text is an empty one; an only document follows itself; repeated rows
    follow each other. An empty table gives an empty one. Result: doc_id, text,
    edited, sketch, edited_sketch, near_edited, near_next.
    """
    rows, order = with_successor(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    size = F.char_length("text")
    moved = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - moved), F.substring("next_text", F.lit(1), moved))
    rows = rows.withColumn("edited", F.coalesce(edited, F.lit("")))
    rows = rows.withColumn("sketch", sketch(F.col("text"), k))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order)).where(~F.col("copy__"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id",
        "text",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
