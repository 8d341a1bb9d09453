"""Operator 2: MinHash near-duplicates, verified by odd sketches and then exactly.

1. Every text becomes the set of its hashed shingles and from that, by one pass,
   ``SAMPLES`` MinHash values. Bands of them are hashed into keys. All values together
   are folded into an odd sketch: every (position, value) flips one bit, so the XOR of
   two sketches counts, but for collisions, the positions in which the two differ.
2. Equal sets are one node, named by 64 bits of their hash. Nodes that share a band key are candidates. With 32 bands
   of 4 values a pair at the similarity 0.85 is missed with probability 6e-11.
3. Candidates are filtered by their odd sketches, and then by a second parity bitmap,
   of the whole set: two sets differ in at least as many shingles as their bitmaps in
   bits, so more bits than a link allows rule it out for certain.
4. Within a key, nodes are compared with its hub: the node whose keys are shared by
   most others. What is linked is one component, and keys within one component are
   done. A large group of copies so costs about one pair per copy.
5. What is still apart in a key is compared in full: in pairs of blocks, on bitmaps in
   memory. Each node first goes on with the nearest node of every other component;
   after these links, all near pairs that are still apart go on.
6. Every link is confirmed on the full sets. Components take the smallest id.

No candidate is dropped for number or size of a key.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored
from .common import marked_present
from .components import components

SHINGLE = 5
SAMPLES, ROWS = 128, 4
BANDS = SAMPLES // ROWS
SKETCH_BITS = 512
PARITY_BITS = 1024
#: Similarity of a link, in hundredths.
LINK_PERCENT = 85
#: Up to so many nodes of a key are paired by a join; more in blocks of this size.
SMALL_KEY, BLOCK = 32, 2048
#: Standard deviations of the sketch's estimate that a candidate may fall short.
DEVIATIONS = 6

SIGNATURE = "n bigint, set_key binary, bands array<bigint>, sketch array<bigint>"

_random = np.random.default_rng(20240229)
_MULTIPLY = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_WORD = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITION = np.arange(SAMPLES, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a finaliser of multiply and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles.

    A-Z are lower-cased, words are what ASCII white space leaves. Fewer words than
    a shingle are one shingle; none give an empty set, as does a null text.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.fromiter(map(digest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total + hashed[k : len(words) - size + 1 + k] * _WORD[k])
    return np.unique(total)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        block = (shingles[at : at + 256, None] ^ _FLIP) * _MULTIPLY
        np.minimum(least, block.min(axis=0), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity, for each bit, of the (position, value) pairs that hash to it."""
    places = mixed(samples + _POSITION * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_parity(shingles: np.ndarray) -> np.ndarray:
    """Parity, for each bit, of the shingles that hash to it."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_bits(percent: int) -> int:
    """Bits in which the sketches of two sets of this similarity differ, at most.

    Of ``SAMPLES`` positions, a binomial number differs; each flips two bits.
    """
    share = 1 - percent / 100
    apart = min(SAMPLES, SAMPLES * share + DEVIATIONS * (SAMPLES * share * (1 - share)) ** 0.5)
    return int(np.ceil(2 * apart))


def similarity_of_sketches(bits: Column | int) -> Column:
    """Estimated similarity from the number of differing bits, collisions allowed for."""
    share = F.least(F.lit(2.0) * bits / SKETCH_BITS, F.lit(0.999999))
    return F.greatest(F.lit(0.0), 1 + F.log(1 - share) * SKETCH_BITS / (4.0 * SAMPLES))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else b""


def _signature(text: str | None) -> tuple:
    shingles = shingle_set(text)
    if not len(shingles):
        return 0, b"", [], []
    samples = min_hashes(shingles)
    bands = mixed(np.arange(BANDS, dtype=np.uint64))
    for row in samples.reshape(BANDS, ROWS).T:
        bands = mixed(bands + row)
    return len(shingles), set_key(shingles), bands.view(np.int64), odd_sketch(samples)


def _signatures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_signature(x) for x in texts], columns=["n", "set_key", "bands", "sketch"])


def _once(function, kind: str):
    """A vectorised function that a plan runs once a row.

    A join by one of its fields adds a filter of nulls, which Spark moves below the function:
    it then runs a second time, in a second Python worker beside the first in every task. What
    is declared as not deterministic stays where it is; equal texts give equal values all the same.
    """
    return F.pandas_udf(function, kind).asNondeterministic()


def signature(text: Column) -> Column:
    return _once(_signatures, SIGNATURE)(text)


def shingle_sets(text: Column) -> Column:
    return _once(_sets, "set_key binary, shingles array<bigint>, parity array<bigint>")(text)


def _sets(texts: pd.Series) -> pd.DataFrame:
    sets = [shingle_set(x) for x in texts]
    return pd.DataFrame(
        {
            "set_key": [set_key(x) for x in sets],
            "shingles": [x.view(np.int64) for x in sets],
            "parity": [set_parity(x) for x in sets],
        }
    )


def _bits(a: str, b: str, size: int) -> Column:
    """Differing bits of two bitmaps."""
    words = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(size // 64)]
    return sum(words[1:], words[0])


def _in_blocks(limit: int, percent: int, nearest: bool):
    """Compares the members of one key in two blocks (or one), by bitmaps."""

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows.side == 0], rows[rows.side == 1]
        if right.empty:
            right = left
        sketches, parities = np.stack(right.sketch.to_list()), np.stack(right.parity.to_list())
        nodes, labels, sizes = right.node.to_numpy(), right.label.to_numpy(), right.n.to_numpy()
        found = []
        for x in left.itertuples():
            near = np.flatnonzero(labels != x.label)
            near = near[np.bitwise_count(sketches[near] ^ x.sketch).sum(axis=1) <= limit]
            apart = np.bitwise_count(parities[near] ^ x.parity).sum(axis=1).astype(np.int64)
            held = apart * (100 + percent) <= (sizes[near] + x.n) * (100 - percent)
            near, apart = near[held], apart[held]
            if nearest and len(near):
                order = np.lexsort((nodes[near], apart))
                near = near[order][np.unique(labels[near][order], return_index=True)[1]]
            found.append(pd.DataFrame({"a": np.minimum(nodes[near], x.node), "b": np.maximum(nodes[near], x.node)}))
        return pd.concat(found).astype("int64").drop_duplicates()

    return pairs


class _Search:
    """Links between nodes, found round by round.

    ``shared``: key, node, score. ``bitmaps``: node, n, sketch, parity. ``sets``: node,
    shingles. ``known``: node and component of what is linked so far.
    """

    def __init__(self, shared: DataFrame, bitmaps: DataFrame, sets: DataFrame, percent: int):
        self.shared, self.bitmaps, self.sets, self.percent = shared, bitmaps, sets, percent
        self.limit = most_bits(percent)
        self.links: DataFrame | None = None
        self.tried: DataFrame | None = None
        self.known: DataFrame | None = None

    def labelled(self) -> DataFrame:
        """Members of the keys that are not yet within one component, with its label."""
        if self.known is None:
            return self.shared.withColumn("label", F.col("node"))
        rows = self.shared.join(self.known, "node", "left")
        rows = rows.withColumn("label", F.coalesce("component", "node")).drop("component")
        apart = rows.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        open_keys = apart.where("least < most").select("key")
        return stored(rows.join(open_keys, "key", "left_semi"), "open-keys")

    def hub_pairs(self, rows: DataFrame) -> DataFrame:
        """Each member with the hub of its key."""
        ranked = F.struct(F.col("score").alias("score"), (-F.col("node")).alias("least"), "label")
        hubs = rows.groupBy("key").agg(F.max(ranked).alias("hub"))
        pairs = rows.join(hubs, "key").where("label <> hub.label")
        node = -F.col("hub.least")
        return pairs.select(F.least("node", node).alias("a"), F.greatest("node", node).alias("b"))

    def all_pairs(self, rows: DataFrame, nearest: bool) -> DataFrame:
        """Pairs of different components in a key whose bitmaps are near."""
        sizes = rows.groupBy("key").agg(F.count("*").alias("members"))
        rows = rows.select("key", "node", "label").join(sizes, "key")
        few = rows.where(F.col("members") <= SMALL_KEY).select("key", "node", "label")
        joined = few.join(few.toDF("key", "node2", "label2"), "key").where("node < node2 and label <> label2")
        blocks = F.ceil(F.col("members") / BLOCK)
        many = rows.where(F.col("members") > SMALL_KEY).withColumn("own", F.pmod(F.xxhash64("node"), blocks))
        many = many.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        many = many.join(self.bitmaps, "node").select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
            "node",
            "label",
            "n",
            "sketch",
            "parity",
        )
        compare = _in_blocks(self.limit, self.percent, nearest)
        blocked = many.groupBy("key", "i", "j").applyInPandas(compare, "a bigint, b bigint")
        return joined.select(F.col("node").alias("a"), F.col("node2").alias("b")).union(blocked)

    def confirm(self, pairs: DataFrame) -> None:
        """Add the pairs whose full sets are similar enough."""
        fresh = pairs.distinct()
        if self.tried is not None:
            fresh = fresh.join(self.tried, ["a", "b"], "left_anti")
        one, other = self.bitmaps.toDF("a", "n", "sketch", "parity"), self.bitmaps.toDF("b", "n2", "sketch2", "parity2")
        near = fresh.join(one, "a").join(other, "b").where(_bits("sketch", "sketch2", SKETCH_BITS) <= self.limit)
        apart = _bits("parity", "parity2", PARITY_BITS) * (100 + self.percent)
        near = stored(near.where(apart <= (F.col("n") + F.col("n2")) * (100 - self.percent)).select("a", "b"), "candidates")
        found = near.join(self.sets.toDF("a", "set_a"), "a").join(self.sets.toDF("b", "set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        found = found.select("a", "b", common.alias("c"), (F.size("set_a") + F.size("set_b") - common).alias("u"))
        links = stored(found.where(F.col("c") * 100 >= F.col("u") * self.percent).select("a", "b"), "links")
        self.tried = near if self.tried is None else self.tried.union(near)
        if not links.isEmpty():
            self.links = links if self.links is None else self.links.union(links)
            self.known = components(self.links)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash), one row per row of ``docs``.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle
    sets. ``component_id`` is the smallest doc_id reachable, ``kept`` says that it is
    the row's own. An empty text (null, or without words) is linked with nothing.
    Rows are compared by their sets alone, so several texts of one doc_id are several
    nodes, each with links of its own; ``text_hash`` tells them apart. A row without a doc_id is in the component
    of the rows with its set, and is kept only if none of them has an id. Ids are
    integers. An empty table gives an empty one.
    """
    signed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = signed.select("doc_id", F.xxhash64("text").alias("text_hash"), signature(F.col("text")).alias("s"))
    signed = signed.select("doc_id", "text_hash", "s.*")
    signed = stored(signed, "signatures")
    full = signed.where("n > 0")
    nodes = full.groupBy("set_key").agg(F.min("doc_id").alias("least"))
    nodes = stored(nodes.select("set_key", F.xxhash64("set_key").alias("node"), "least"), "nodes")
    known = nodes.where("least is not null").select("set_key", "node", F.col("least").alias("doc_id"))
    first = full.join(known, ["set_key", "doc_id"]).dropDuplicates(["set_key"])
    keys = first.select("node", F.explode("bands").alias("key"))
    counts = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = stored(keys.join(counts, "key"), "shared-keys")
    found = _components(docs, doc_id, text, first, shared, percent)
    if found is None:
        named = nodes.select("set_key", F.col("least").alias("component"))
    else:
        labelled = stored(nodes.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")), "labelled")
        names = labelled.groupBy("label").agg(F.min("least").alias("name"))
        named = labelled.join(names, "label").select("set_key", F.col("name").alias("component"))
    result = signed.join(named, "set_key", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("doc_id").isNull() & component.isNull()).alias("kept"),
        "text_hash",
    )


def _sets_of_nodes(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles, parity) from texts (doc_id, text), one row per node."""
    sets = rows.select("doc_id", shingle_sets(F.col("text")).alias("s")).select("doc_id", "s.*")
    sets = sets.join(wanted.select("node", "doc_id", "set_key"), ["doc_id", "set_key"]).dropDuplicates(["set_key"])
    return sets.select("node", "shingles", "parity")


def _components(docs, doc_id: str, text: str, first: DataFrame, shared: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of the linked nodes, or none."""
    if shared.isEmpty():
        return None
    score = shared.groupBy("node").agg(F.sum("members").alias("score"))
    shared = stored(shared.select("key", "node").join(score, "node"), "scored-keys")
    wanted = first.select("node", "doc_id", "set_key", "n", "sketch").join(score.select("node"), "node", "left_semi")
    wanted = stored(wanted, "sketches")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = marked_present(rows, "doc_id", wanted.select("doc_id")).where("maybe__").select("doc_id", "text")
    rows = stored(rows.join(wanted.select("doc_id"), "doc_id", "left_semi"), "candidate-texts")
    sets = stored(_sets_of_nodes(rows, wanted), "sets")
    bitmaps = wanted.select("node", "n", "sketch").join(sets.select("node", "parity"), "node")
    search = _Search(shared, stored(bitmaps, "bitmaps"), sets.select("node", "shingles"), percent)
    search.confirm(search.hub_pairs(shared.withColumn("label", F.col("node"))))
    for nearest in (True, False):
        rows = search.labelled()
        if rows.isEmpty():
            break
        search.confirm(search.all_pairs(rows, nearest))
    return search.known
