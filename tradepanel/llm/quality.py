"""Operator 6: a quality classifier as a generalised additive model with pairs.

The score of a text is the sum of one table entry per feature and one per pair of
features. Tables are learnt by cyclic boosting: round after round, each feature in
turn gets a tree of at most three leaves over its bins, fitted to the residuals and
added to its table; then the pairs whose residuals gain most from four quadrants are
boosted in the same way. Scoring looks up bins and adds, for a batch at a time.

Features come from the whole text, in one pass per text. The model is fitted on the
driver on at most ``MAX_SAMPLE`` labelled rows; everything else runs by rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on, at most in expectation.
MAX_SAMPLE = 20_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
STEP, SMOOTH = 0.15, 2.0
THRESHOLD = 0.3
HELD_OUT = 5

FEATURES = (
    "log_words",
    "word_length",
    "word_length_spread",
    "upper",
    "upper_words",
    "digits",
    "marks",
    "rare_marks",
    "non_ascii",
    "blank",
    "line_words",
    "distinct_words",
    "repeated_neighbours",
    "top_word",
    "distinct_lines",
    "marked_words",
    "single_letters",
)
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Marks that plain prose has (fixed values).
_PROSE_MARKS = np.zeros(256, bool)
_PROSE_MARKS[[ord(c) for c in ".,;:?'\"()-"]] = True
_ENDS = frozenset(b".,;:?'\")")


def features_of(text: str | None) -> list[float]:
    """The features of a whole text; 0 wherever there is nothing to measure."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, number = len(data), len(words)
    lengths = np.fromiter(map(len, words), np.int64, number)
    marks = int(counts[_MARKS].sum())
    letters = int(counts[_LETTERS].sum()) + int(counts[128:].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = Counter(words)
    upper = sum(map(bytes.isupper, words))
    marked = sum([w[-1] < 128 and _MARKS[w[-1]] and w[-1] not in _ENDS for w in kinds.elements()]) if marks else 0
    return [
        math.log1p(number),
        float(lengths.mean()),
        float(lengths.std()),
        int(counts[65:91].sum()) / max(letters, 1),
        upper / number,
        int(counts[48:58].sum()) / size,
        marks / size,
        (marks - int(counts[_PROSE_MARKS].sum())) / size,
        int(counts[128:].sum()) / size,
        int(counts[[9, 10, 11, 12, 13, 32]].sum()) / size,
        math.log1p(number / len(lines)),
        len(kinds) / number,
        sum(map(eq, words, words[1:])) / number,
        max(kinds.values()) / number,
        len(set(lines)) / len(lines),
        marked / number,
        int((lengths == 1).sum()) / number,
    ]


def feature_matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features_of(x) for x in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    """Bin edges and tables of the features, and of the pairs of features."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, matrix: np.ndarray) -> np.ndarray:
        total = np.full(len(matrix), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], matrix[:, k], "right")]
        if self.pairs:
            coarse = [np.searchsorted(e, matrix[:, k], "right") for k, e in enumerate(self.pair_edges)]
            for a, b, table in self.pairs:
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_cut(grad: np.ndarray, hess: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """Gain and place of the best cut of the bins from low to high."""
    if high - low < 2:
        return 0.0, low
    left_g, left_h = np.cumsum(grad[low:high])[:-1], np.cumsum(hess[low:high])[:-1]
    all_g, all_h = grad[low:high].sum(), hess[low:high].sum()
    gain = left_g**2 / (left_h + SMOOTH) + (all_g - left_g) ** 2 / (all_h - left_h + SMOOTH) - all_g**2 / (all_h + SMOOTH)
    at = int(gain.argmax())
    return float(gain[at]), low + at + 1


def _tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Leaf values by bin of a tree with at most two cuts."""
    size = len(grad)
    gain, cut = _best_cut(grad, hess, 0, size)
    cuts = [0, size]
    if gain > 0:
        cuts = [0, cut, size]
        second = max(_best_cut(grad, hess, 0, cut), _best_cut(grad, hess, cut, size))
        if second[0] > 0:
            cuts = sorted({*cuts, second[1]})
    values = np.empty(size)
    for low, high in zip(cuts, cuts[1:]):
        values[low:high] = STEP * grad[low:high].sum() / (hess[low:high].sum() + SMOOTH)
    return values


def _quadrants(grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    """Gain and cuts of the best four quadrants of a grid of bins."""
    g = np.pad(grad.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(hess.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    total = 0.0
    for rows, columns in ((0, 0), (0, 1), (1, 0), (1, 1)):
        def corner(s, rows=rows, columns=columns):
            top = s[1:-1, :] if not rows else s[-1:, :] - s[1:-1, :]
            return top[:, 1:-1] if not columns else top[:, -1:] - top[:, 1:-1]

        total = total + corner(g) ** 2 / (corner(h) + SMOOTH)
    if not total.size:
        return 0.0, 0, 0
    at = np.unravel_index(int(total.argmax()), total.shape)
    gain = float(total[at]) - float(g[-1, -1] ** 2 / (h[-1, -1] + SMOOTH))
    return gain, int(at[0]) + 1, int(at[1]) + 1


def fit(matrix: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting of the features' tables and then of the best pairs' tables.

    Rows that are all of one label, or none at all, give a model without tables: the
    smoothed share of label 1.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if not len(labels) or labels.min() == labels.max():
        return model
    width = matrix.shape[1]
    model.edges = [_edges(matrix[:, k], BINS) for k in range(width)]
    bins = [np.searchsorted(model.edges[k], matrix[:, k], "right") for k in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(labels), model.base)
    for _ in range(ROUNDS):
        for k in range(width):
            chance = 1 / (1 + np.exp(-total))
            size = len(model.tables[k])
            tree = _tree(
                np.bincount(bins[k], labels - chance, size), np.bincount(bins[k], chance * (1 - chance), size)
            )
            model.tables[k] += tree
            total += tree[bins[k]]
    model.pair_edges = [_edges(matrix[:, k], PAIR_BINS) for k in range(width)]
    coarse = [np.searchsorted(model.pair_edges[k], matrix[:, k], "right") for k in range(width)]

    def grids(a: int, b: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        chance, flat = 1 / (1 + np.exp(-total)), coarse[a] * shape[1] + coarse[b]
        cells = shape[0] * shape[1]
        grad = np.bincount(flat, labels - chance, cells).reshape(shape)
        return grad, np.bincount(flat, chance * (1 - chance), cells).reshape(shape), shape

    gains = [(_quadrants(*grids(a, b)[:2])[0], a, b) for a in range(width) for b in range(a + 1, width)]
    chosen = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    tables = {pair: np.zeros(grids(*pair)[2]) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            grad, hess, shape = grids(a, b)
            _, row, column = _quadrants(grad, hess)
            tree = np.zeros(shape)
            for rows in (slice(0, row), slice(row, None)):
                for columns in (slice(0, column), slice(column, None)):
                    tree[rows, columns] = STEP * grad[rows, columns].sum() / (hess[rows, columns].sum() + SMOOTH)
            tables[a, b] += tree
            total += tree[coarse[a], coarse[b]]
    model.pairs = [(a, b, table) for (a, b), table in tables.items()]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from; a row without an id is one of them."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT == 0


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_sample: int = MAX_SAMPLE
) -> Model:
    """Fit on labelled documents that are not held out.

    Beyond ``max_sample`` labelled rows, those whose id hashes low are taken, the same
    ones every time. Labels that are null, or of no document, are left out; of several
    labels of a document, the lowest holds.
    """
    known = labels.select(F.col(doc_id).alias("id__"), F.col(label).cast("int").alias("label__")).where(
        "id__ is not null and label__ is not null"
    )
    known = known.where(~held_out(F.col("id__"))).groupBy("id__").agg(F.min("label__").alias("label__"))
    rows = known.count()
    if rows > max_sample:
        draw = F.pmod(F.xxhash64(F.col("id__"), F.lit(6)), F.lit(1 << 30))
        known = known.where(draw < int(max_sample / rows * (1 << 30)))
    texts = docs.select(F.col(doc_id).alias("id__"), F.col(text).alias("text__"))
    # at most max_sample pairs of numbers
    found = texts.join(F.broadcast(known), "id__").withColumn("f__", _feature_column(F.col("text__")))
    got = found.select("id__", "label__", "f__").collect()
    got.sort(key=lambda r: (r.id__, r.label__, tuple(r.f__)))
    matrix = np.array([r.f__ for r in got], np.float64).reshape(len(got), len(FEATURES))
    return fit(matrix, np.array([r.label__ for r in got], np.float64))


def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features_of(x) for x in texts], dtype=object)


def _feature_column(text: Column) -> Column:
    return F.pandas_udf(_features, "array<double>")(text)


def score(docs: DataFrame, model: Model, text: str = "text", output: str = "score") -> DataFrame:
    """Add the score (0 to 1; higher: label 1 is likelier) of each whole text.

    A null text scores as an empty one. A column of that name is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(feature_matrix(texts)), dtype="float64")

    return docs.withColumn(output, F.pandas_udf(scores, "double")(F.col(text)))
