"""Operator 13: divergence of the term frequencies of sources, by pair tasks.

1. Texts become counts of their terms, summed up in the worker and then by (lang, term);
   terms in too few documents of a language go. What is left is written.
2. Kept terms get ids within slices of a bounded number of terms. Of each group (lang,
   source) and slice there is one sparse row: the sorted ids and their counts.
3. Each unordered pair of groups of one language is a task per slice. The rows of both
   groups are co-grouped there; the shorter ids are searched in the longer ones, and
   overlaps, terms of one side and terms of the other are priced both ways. Terms that
   both lack have one price, which is taken as often as there are such terms.

No task holds more of a group than a slice, so a source with a third of all rows has
more tasks, not larger ones.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

#: Documents of a language that have a term, at least.
LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
#: Terms in a slice, about.
SLICE = 16_384
#: Distinct (group, term) that a worker holds before it passes them on.
HELD_TERMS = 200_000

#: Lower-cases A-Z and makes blanks of all other ASCII characters; bytes beyond are kept.
_LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms(text: bytes | None) -> list[bytes]:
    """Stretches of letters: A-Z, a-z and all characters beyond ASCII."""
    return text.translate(_LETTERS).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to occurrences and documents of each term."""
    counts: defaultdict[tuple, Counter] = defaultdict(Counter)
    documents: defaultdict[tuple, Counter] = defaultdict(Counter)

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            held = documents[lang, source]
            names = list(found)
            yield pa.record_batch(
                [
                    pa.repeat(lang, len(names)),
                    pa.repeat(source, len(names)),
                    pa.array(names, pa.binary()).cast(pa.string()),
                    pa.array(found.values(), pa.int64()),
                    pa.array([held[x] for x in names], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()
        documents.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if not (found := terms(text)):
                continue
            size -= len(counts[lang, source])
            counts[lang, source].update(found)  # counted in C, as a mapping is not
            size += len(counts[lang, source])
            documents[lang, source].update(set(found))
            if size > HELD_TERMS:
                yield from passed_on()
                size = 0
    yield from passed_on()


def group_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, term, n, docs, sources): kept terms with all their occurrences, and an
    array of (source, n) by source. Null texts and names are empty ones."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    counted = docs.select(*blank, F.col(text).cast("binary").alias("text")).mapInArrow(_counted, COUNTS)
    # One exchange by term serves both sums: those by source and those over sources.
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources")
    return (
        by_source.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), held)
        .where(F.col("docs") >= LEAST_DOCUMENTS)
    )


def priced(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), exact."""
    wide = (n + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", wide, (total + kept).cast("decimal(29,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _prices(counts: np.ndarray, weight: int) -> np.ndarray:
    """As ``priced``, for an array; beyond 64 bits by whole numbers of any size."""
    if counts.max(initial=0) < (1 << 63) // SCALE - 1:
        return 1 + (counts + 1) * SCALE // weight
    return np.array([1 + (int(n) + 1) * SCALE // weight for n in counts], np.int64)


def _gaps(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // q).sum())


def overlap(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ids that both sorted arrays have: each of the shorter one is
    looked up by halving in what is left of the longer."""
    if len(left) > len(right):
        return overlap(right, left)[::-1]
    if not len(left):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(right, left)
    here = np.flatnonzero(right[np.minimum(at, len(right) - 1)] == left)
    return here, at[here]


PAIR = "lang string, a string, b string, ab bigint, ba bigint, either bigint"


def _merged(left: pa.Table, right: pa.Table) -> pa.Table:
    """One slice of two groups: what its terms add to the value of a by b and of b by a."""
    some = left if left.num_rows else right
    row = {c: some.column(c)[0].as_py() for c in ("lang", "a", "b", "weight_a", "weight_b")}
    ids, counts = zip(*(_slice(x) for x in (left, right)), strict=True)
    prices = [_prices(counts[i], row[f"weight_{'ab'[i]}"]) for i in range(2)]
    none = [np.array([1 + SCALE // row[f"weight_{x}"]]) for x in "ab"]
    both = overlap(*ids)
    alone = [np.delete(prices[i], both[i]) for i in range(2)]
    values = [
        _gaps(prices[i][both[i]], prices[1 - i][both[1 - i]]) + _gaps(alone[i], none[1 - i]) + _gaps(none[i], alone[1 - i])
        for i in range(2)
    ]
    either = len(ids[0]) + len(ids[1]) - len(both[0])
    names = ["lang", "a", "b", "ab", "ba", "either"]
    return pa.table([[x] for x in (row["lang"], row["a"], row["b"], *values, either)], names=names)


def _slice(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and counts of the one row, if there is one."""
    if not rows.num_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(rows.column(c).chunk(0).flatten().to_numpy().astype(np.int64) for c in ("ids", "counts"))


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", ranks: int = TERM_RANKS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of a language and source.

    p = 1 + floor(10^9 (n + 1) / (N + V)) is the price of a term with n occurrences in
    a group that has N in all, over the V kept terms of the language, and the value of p
    by q is floor((p - q)^2 / q). Part ``pair``: the values of all kept terms against each
    other source, added up, 0 without kept terms. Part ``term``: the group's terms that
    are dearer than in the whole language, the first ``ranks`` of them. Ranks go by
    falling value and then by item.

    Null texts are empty, null names of a language or source are '' and so one with
    these. Every row is a document, repeated ones too. A group without terms takes part
    in pairs; a language of one source has none. No documents give no rows, and other
    columns are not read.
    """
    kept = stored(group_terms(docs, text, lang, source), "terms")
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    used = kept.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    groups = docs.select(*blank).distinct().join(used, ["lang", "source"], "left").join(whole, "lang", "left")
    groups = stored(groups.fillna(0, ["total", "kept", "lang_total"]), "groups")
    pairs, dearer = _pairs(kept, groups), _dearer_terms(kept, groups)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = [
        rows.withColumn("rank", F.row_number().over(by_value)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
        )
        for part, rows in (("pair", pairs), ("term", dearer))
    ]
    return first[0].unionByName(first[1].where(F.col("rank") <= ranks))


def _slices(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, slice, ids, counts, weight): the sparse rows of all groups."""
    sizes = groups.select("lang", "kept").distinct()
    cut = kept.join(sizes, "lang")
    cut = cut.withColumn("slice", F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / SLICE)))
    within = Window.partitionBy("lang", "slice").orderBy("term")
    single = cut.withColumn("id", F.row_number().over(within)).select("lang", "slice", "id", F.inline("sources"))
    entries = F.sort_array(F.collect_list(F.struct("id", "n")))
    rows = single.groupBy("lang", "slice", "source").agg(entries.alias("entries"))
    return rows.select("lang", "slice", "source", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two groups of a language, both ways."""
    sparse = _slices(kept, groups)
    weight = (F.col("total") + F.col("kept")).alias("weight")
    own = groups.select("lang", "source", weight)
    other = groups.select("lang", F.col("source").alias("other"), weight.alias("other_weight"))
    met = own.join(other, "lang").where("source <> other")
    rows = sparse.join(met, ["lang", "source"])
    key = ["lang", "a", "b", "slice"]
    low = rows.where("source < other").select(
        "lang", F.col("source").alias("a"), F.col("other").alias("b"), "slice", "ids", "counts",
        F.col("weight").alias("weight_a"), F.col("other_weight").alias("weight_b"),
    )
    high = rows.where("source > other").select(
        "lang", F.col("other").alias("a"), F.col("source").alias("b"), "slice", "ids", "counts",
        F.col("other_weight").alias("weight_a"), F.col("weight").alias("weight_b"),
    )
    high = high.toDF(*high.columns)  # columns of their own, for the co-group
    merged = low.groupBy(*key).cogroup(high.groupBy(*key)).applyInArrow(_merged, PAIR)
    sums = merged.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("ab", "ba", "either")])
    ways = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("other"), F.col("ab").alias("found"), "either")
    ways = ways.unionByName(sums.select("lang", F.col("b").alias("source"), F.col("a").alias("other"), F.col("ba").alias("found"), "either"))
    zero = F.lit(0).cast("bigint")
    whole = groups.select("lang", "source", "kept")
    grid = met.join(whole, ["lang", "source"]).join(ways, ["lang", "source", "other"], "left")
    lacking = F.col("kept") - F.coalesce("either", zero)
    absent = distance(*[1 + F.call_function("div", F.lit(SCALE).cast("bigint"), F.col(c)) for c in ("weight", "other_weight")])
    value = F.when(F.col("kept") > 0, F.coalesce("found", zero) + lacking * absent).otherwise(zero)
    return grid.select("lang", "source", F.col("other").alias("item"), value.alias("value"))


def _dearer_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms of a group with a price above that of
    the language."""
    each = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("sources"))
    each = each.join(groups, ["lang", "source"])
    p, q = priced(F.col("n"), F.col("total"), F.col("kept")), priced(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    each = each.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    return each.select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))
