"""Operator 11: SimHash near-duplicates by anchor-point covering.

1. A text becomes a fingerprint of 64 bits: a bit is set if over half of the hashes of
   its shingles have it. Equal fingerprints are one node.
2. Two fingerprints with at most ``MOST_BITS`` = 4 different bits have at most 2 in
   their upper halves, or at most 1 in their lower ones. Each half has a covering code
   as its anchors: a word of the perfect binary Golay code on 23 bits, and the other 9
   bits as they are. Every half lies within the covering radius 3 of one anchor, its
   home.
3. A fingerprint is replicated to every anchor within the radius plus the threshold
   (2 or 1) of its half. Of two near fingerprints, each so visits the home of the
   other: no pair is missed. That makes about 120 rows a fingerprint, whatever the data.
4. Fingerprints are compared per anchor, those at home with those that visit. First
   each one at home is compared with one hub of the anchor, in a few rounds with other
   hubs: what is linked is one component, so a large group of near copies costs one
   pair a copy. Then visitors meet those at home in other components.

Nothing is dropped for the size of an anchor. Joins are on the anchor, narrow, and
can be split by adaptive execution where one is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored
from .components import components

SHINGLE = 4
SEED = 42
#: Different bits of a link, at most.
MOST_BITS = 4
#: Different bits in the upper and the lower half of which one holds for every link.
THRESHOLDS = (2, 1)
#: Rounds in which those at home are compared with one hub of their anchor.
HUB_ROUNDS = 3

CODE_BITS, PLAIN_BITS, RADIUS = 23, 9, 3
#: Generator polynomial of the binary Golay code, a fixed value.
GOLAY = 0b101011100011
#: Shingles, and bits of shingles, that are in memory at once.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """Of the text in UTF-8: A-Z lower-cased, words parted by ASCII white space.

    Fewer words than a shingle are one; no word or no text gives 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    count = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + SHINGLE - 1]
        ones += _ones(part)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def _ones(words: list[bytes]) -> np.ndarray:
    """How many hashes of the shingles of these words have each bit, highest first."""
    joined, size = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: len(words) - size]]).tolist()
    shingles = map(joined.__getitem__, map(slice, starts, (ends[size - 1 :] - 1).tolist()))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(starts))
    bits = np.unpackbits(hashed.astype(">u8").view(np.uint8)).reshape(-1, 64)
    whole = len(bits) // 255 * 255
    sums = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return sums + bits[whole:].sum(axis=0, dtype=np.int64)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(x) for x in texts], dtype="int64")


def fingerprint_column(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "bigint")(text.cast("binary"))


def as_hex(fingerprints: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprints), 16, "0"))


class Anchors:
    """The covering code of a half, and which anchors lie near a word.

    ``patterns`` are the errors of weight 5 or less, ordered by syndrome and weight, so
    a word XOR the first patterns of its syndrome gives the code words next to it.
    """

    def __init__(self) -> None:
        most = RADIUS + max(THRESHOLDS)
        weighted = [(sum(1 << i for i in some), size) for size in range(most + 1) for some in combinations(range(CODE_BITS), size)]
        errors = np.array([x for x, _ in weighted], np.int64)
        weights = np.array([size for _, size in weighted])
        self.tables = [self._remainders(np.arange(256) << shift) for shift in (0, 8, 16)]
        syndromes = self.syndrome(errors)
        order = np.lexsort((weights, syndromes))
        self.patterns = errors[order]
        kinds = 1 << (CODE_BITS - 12)
        self.first = np.searchsorted(syndromes[order], np.arange(kinds))
        self.within = np.stack([np.bincount(syndromes[weights <= w], minlength=kinds) for w in range(most + 1)])

    @staticmethod
    def _remainders(words: np.ndarray) -> np.ndarray:
        """Of the words as polynomials, divided by that of the code."""
        words = words.copy()
        for bit in range(words.max(initial=1).item().bit_length() - 1, 10, -1):
            words ^= (words >> bit & 1) * (GOLAY << (bit - 11))
        return words

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        low, middle, high = self.tables
        return low[words & 255] ^ middle[words >> 8 & 255] ^ high[words >> 16 & 255]

    def near(self, words: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``words``, code word) for every code word within the distance."""
        syndromes = self.syndrome(words)
        counts = self.within[distance][syndromes]
        place = np.repeat(np.arange(len(words)), counts)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
        return place, words[place] ^ self.patterns[self.first[syndromes[place]] + nth]

    def homes(self, fingerprints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(place, anchor) of the home of each half."""
        return [self._around(fingerprints, half, 0, RADIUS) for half in range(2)]

    def visits(self, fingerprints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, anchor) of the anchors within radius plus threshold of each half.

        Bits outside the code word are flipped at most as often as the threshold
        allows, since an anchor has those of its members as they are.
        """
        for half, threshold in enumerate(THRESHOLDS):
            for flips in range(threshold + 1):
                for some in combinations(range(PLAIN_BITS), flips):
                    yield self._around(fingerprints, half, sum(1 << i for i in some), RADIUS + threshold - flips)

    def _around(self, fingerprints: np.ndarray, half: int, flipped: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        words = fingerprints >> 32 * (1 - half) & 0xFFFFFFFF
        plain = words & ((1 << PLAIN_BITS) - 1)
        place, code = self.near(words >> PLAIN_BITS, distance)
        return place, half << 32 | code << PLAIN_BITS | (plain[place] ^ flipped)


_anchors: list[Anchors] = []


def _replicated(visiting: bool):
    """Rows (fingerprint, label) to (anchor, fingerprint, label)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _anchors:
            _anchors.append(Anchors())
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in range(2)]
            for at in range(0, len(own[0]), 4096):
                some, labels = (x[at : at + 4096] for x in own)
                found = _anchors[0].visits(some) if visiting else _anchors[0].homes(some)
                for place, anchor in found:
                    yield pa.record_batch([anchor, some[place], labels[place]], names=["anchor", "fingerprint", "label"])

    return rows


SCHEMA = "anchor bigint, fingerprint bigint, label bigint"


def _at_home(labelled: DataFrame) -> DataFrame:
    return labelled.select("fingerprint", "label").mapInArrow(_replicated(False), SCHEMA)


def _visiting(labelled: DataFrame) -> DataFrame:
    return labelled.select("fingerprint", "label").mapInArrow(_replicated(True), SCHEMA)


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MOST_BITS


class _Search:
    """Links between distinct fingerprints, and the labels that follow from them."""

    def __init__(self, nodes: DataFrame):
        self.nodes, self.links = nodes, None
        self.labelled = nodes.withColumn("label", F.col("fingerprint"))

    def add(self, links: DataFrame) -> bool:
        """Whether there are new links; labels are those of all links so far."""
        links = stored(links, "links")
        if links.isEmpty():
            return False
        self.links = links if self.links is None else self.links.unionByName(links)
        found = components(self.links).toDF("fingerprint", "component")
        labelled = self.nodes.join(found, "fingerprint", "left")
        label = F.coalesce("component", "fingerprint").alias("label")
        self.labelled = stored(labelled.select("fingerprint", label), "labels")
        return True

    def with_hub(self, number: int) -> DataFrame:
        """Links of those at home with the hub of their anchor, in another component."""
        rows = _at_home(self.labelled)
        rank = F.struct(F.xxhash64(F.lit(number), "fingerprint").alias("rank"), "fingerprint", "label")
        hubs = rows.groupBy("anchor").agg(F.min(rank).alias("hub"))
        found = rows.join(hubs, "anchor").where("label <> hub.label")
        found = found.select("fingerprint", "label", F.col("hub.fingerprint").alias("other"))
        found = found.where(_near("fingerprint", "other"))
        return found.select(F.col("fingerprint").alias("a"), F.col("other").alias("b"))

    def with_visitors(self) -> DataFrame:
        """Links between components: of those at home with all that visit.

        Of two near fingerprints each visits the home of the other, so it is enough to
        look for the visitor with the smaller label.
        """
        homes = _at_home(self.labelled).toDF("anchor", "other", "other_label")
        met = _visiting(self.labelled).join(homes, "anchor")
        met = met.where(F.col("label") < F.col("other_label")).where(_near("fingerprint", "other"))
        return met.select(F.col("label").alias("a"), F.col("other_label").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Fingerprints with ``MOST_BITS`` or fewer different bits are linked; ``component_id``
    is the smallest doc_id reachable. Texts without words, empty and null ones have the
    fingerprint 0 and are linked like any other. Rows are linked by their texts alone:
    several rows of one doc_id are documents of their own, and a row without a doc_id
    links others, but gives no component its name; a component of such rows alone has
    none. Ids may be of any type that has an order. An empty table gives an empty one,
    and other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fingerprint"))
    return linked(stored(rows, "fingerprints"))


def linked(rows: DataFrame) -> DataFrame:
    """``near_duplicates`` from rows of doc_id and fingerprint (a bigint)."""
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    search = _Search(classes.select("fingerprint"))
    for number in range(HUB_ROUNDS):
        if not search.add(search.with_hub(number)):
            break
    search.add(search.with_visitors())
    labelled = search.labelled.join(classes, "fingerprint")
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(names, "label").select("fingerprint", "component_id")
    found = rows.join(named, "fingerprint")
    return found.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")
