"""Operator 4: personal data by patterns and a weakly supervised span classifier.

Four kinds are certain and come from patterns with checks: email, ip, card, phone.
Credentials have no sure pattern. Strings that may be one are candidates, on which
labelers vote for or against, or abstain: a pattern, a gazetteer of words that name
credentials, the context around the string, and its shape. Expectation-maximisation
over the counts of all vote patterns in the corpus estimates how reliable each labeler
is. The probabilities that follow train a logistic classifier on features of the span,
and what it takes for a credential is added as a span of kind ``secret``.

Everything that touches texts is column expressions. The driver sees one row per
combination of votes and features, whose number is fixed, whatever the corpus.

Patterns hold no ambiguous repetition: a start inside a run of characters is looked
at only where a match has just ended, so long runs cost time in proportion.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"

#: Possessive repetition finds the same matches as greedy one here: what follows a run
#: is never part of it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = (
    r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+={0,2}"
)
#: Code points before a candidate that labelers see.
CONTEXT = 32

#: Words that name credentials, and beginnings that issuers give them (fixed values).
NAMES = (
    "token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key",
    "auth", "bearer", "credential", "private_key", "client_secret",
)
PREFIXES = ("sk-", "sk_", "pk_", "ghp_", "gho_", "AKIA", "xox", "eyJ", "AIza")

LABELERS = ("pattern", "gazetteer", "context", "shape")
EM_ROUNDS = 30
FIT_ROUNDS, FIT_STEP, RIDGE = 400, 0.5, 0.01
TAKEN = 0.5


def located(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value), in code points.

    The pieces between matches and the matches alternate, so running sums of their
    lengths are the places.
    """

    def places(values: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        lengths = F.zip_with(F.slice(pieces, 1, F.size(values)), values, lambda p, v: F.char_length(p) + F.char_length(v))
        ends = running(lengths, lambda a, b: a + b)
        spans = F.zip_with(
            ends, values, lambda e, v: F.struct((e - F.char_length(v)).alias("start"), e.alias("end"), v.alias("value"))
        )
        return F.when(F.size(values) > 0, spans).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        number = F.ltrim(part, F.lit("0"))
        return F.when(F.char_length(number) <= 3, F.coalesce(number.try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False))

    return F.forall(F.split(value, r"\."), small)


def is_card(value: Column) -> Column:
    """13 to 19 digits whose weighted sum (every second one doubled) is a multiple of 10."""

    def luhn(digits: Column) -> Column:
        size = F.char_length(digits)

        def weight(total: Column, i: Column) -> Column:
            digit = F.substring(digits, size - i, F.lit(1)).cast("int")
            twice = digit * 2
            return total + F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

        total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), weight)
        return F.when(size.between(13, 19), total % 10 == 0).otherwise(F.lit(False))

    return let(_digits(value), luhn)


def is_phone(value: Column) -> Column:
    return F.char_length(_digits(value)).between(9, 15)


BASE: dict[str, tuple[str, Callable[[Column], Column] | None]] = {
    "email": (EMAIL, None),
    "ip": (IP, is_ip),
    "card": (CARD, is_card),
    "phone": (PHONE, is_phone),
}


def base_spans(text: Column, kind: str) -> Column:
    pattern, holds = BASE[kind]
    found = located(text, pattern)
    return found if holds is None else F.filter(found, lambda s: holds(s.value))


def _candidate(text: Column, span: Column) -> Column:
    """Votes (1, -1 or 0) and features (small integers) of a candidate."""
    value = span.value
    start = F.greatest(span.start - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, start + 1, span.start - start))
    before_rest = F.regexp_replace(before, r"[\"'\x20=:]+$", "")
    size = F.char_length(value)
    digits = F.char_length(_digits(value))
    changes = F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)))
    hexadecimal = value.rlike("^[0-9a-fA-F]{32,}$")
    issued = F.lit(False)
    for prefix in PREFIXES:
        issued = issued | value.startswith(prefix)
    named = before_rest.rlike("(?:" + "|".join(NAMES) + ")$")
    assigned = before.rlike(r"[=:]\x20?[\"']?$")
    quoted = before.rlike("[\"']$")
    prose = before.rlike(r"[a-z]\x20$") & ~named
    wordy = value.rlike("[a-zA-Z]{9,}")
    return F.struct(
        F.when(hexadecimal | issued, 1).when(wordy, -1).otherwise(0).alias("pattern"),
        F.when(named, 1).when(prose, -1).otherwise(0).alias("gazetteer"),
        F.when(assigned, 1).when(prose, -1).otherwise(0).alias("context"),
        F.when((changes >= 4) & (digits * 10 >= size), 1).when(changes <= 1, -1).otherwise(0).alias("shape"),
        F.least(F.floor(size / 8), F.lit(6)).cast("int").alias("length"),
        F.floor(digits * 4 / size).cast("int").alias("digits"),
        F.least(changes, F.lit(5)).alias("changes"),
        quoted.cast("int").alias("quoted"),
        assigned.cast("int").alias("assigned"),
        named.cast("int").alias("named"),
        (hexadecimal | issued).cast("int").alias("regular"),
        wordy.cast("int").alias("wordy"),
    )


FEATURES = ("length", "digits", "changes", "quoted", "assigned", "named", "regular", "wordy")


def vote_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How many candidates have each combination of votes and features."""
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = docs.select(whole.alias("text"), located(whole, CANDIDATE).alias("spans")).where(F.size("spans") > 0)
    found = spans.select(F.explode(F.transform("spans", lambda s: _candidate(F.col("text"), s))).alias("c")).select("c.*")
    return found.groupBy(*LABELERS, *FEATURES).agg(F.count("*").alias("times"))


def reliabilities(votes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Accuracy of each labeler, and the probability of each vote pattern, by EM.

    A labeler that does not abstain is right with its accuracy, whatever the class.
    Accuracies start at 0.8 and stay between 0.55 and 0.99, so that the classes keep
    their meaning; a prior of ten votes holds rare labelers near 0.8.
    """
    accuracy, share = np.full(votes.shape[1], 0.8), 0.5
    chance = np.full(len(times), 0.5)
    for _ in range(EM_ROUNDS):
        weight = np.log(accuracy / (1 - accuracy))
        chance = 1 / (1 + np.exp(-(votes @ weight + math.log(share / (1 - share)))))
        right = (chance[:, None] * (votes > 0) + (1 - chance[:, None]) * (votes < 0)) * times[:, None]
        cast = (votes != 0) * times[:, None]
        accuracy = np.clip((right.sum(axis=0) + 8) / (cast.sum(axis=0) + 10), 0.55, 0.99)
        share = float(np.clip((chance @ times + 1) / (times.sum() + 2), 0.01, 0.99))
    return accuracy, chance


def classifier(features: np.ndarray, chance: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Weights (the last one constant) of a logistic model of the probabilities."""
    scale = np.maximum(np.abs(features).max(axis=0, initial=0), 1)
    rows = np.hstack([features / scale, np.ones((len(features), 1))])
    weight, share = np.zeros(rows.shape[1]), times / max(times.sum(), 1)
    for _ in range(FIT_ROUNDS):
        found = 1 / (1 + np.exp(-rows @ weight))
        weight -= FIT_STEP * 4 * (rows.T @ (share * (found - chance)) + RIDGE * np.append(weight[:-1], 0) / len(weight))
    return np.append(weight[:-1] / scale, weight[-1])


def train(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """The span classifier of this corpus; none where there is no candidate."""
    rows = sorted(vote_counts(docs, text).collect())
    if not rows:
        return None
    table = np.array(rows, np.float64)
    votes, features, times = table[:, : len(LABELERS)], table[:, len(LABELERS) : -1], table[:, -1]
    _, chance = reliabilities(votes, times)
    return classifier(features, chance, times)


def secret_spans(text: Column, weights: np.ndarray | None) -> Column:
    """Candidates that the classifier takes for credentials."""
    found = located(text, CANDIDATE)
    if weights is None:
        return F.filter(found, lambda _: F.lit(False))

    def taken(span: Column) -> Column:
        def score(c: Column) -> Column:
            total = F.lit(float(weights[-1]))
            for name, weight in zip(FEATURES, weights, strict=False):
                total = total + c[name] * float(weight)
            return 1 / (1 + F.exp(-total)) >= TAKEN

        return let(_candidate(text, span), score)

    return F.filter(found, taken)


def find_personal_data(docs: DataFrame, text: str = "text", weights: np.ndarray | None = None) -> DataFrame:
    """Add, for each kind, a column of spans (start, end, value), as ``email_spans``.

    Code points, end exclusive, in order of start. A null text is an empty one and
    has none. Credentials that overlap a certain span are left to that. Columns of
    these names are replaced; rows stay as they are.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({f"{kind}_spans": base_spans(whole, kind) for kind in KINDS})
    certain = F.concat(*[F.col(f"{kind}_spans") for kind in KINDS])
    alone = F.filter(
        secret_spans(whole, weights),
        lambda s: ~F.exists(certain, lambda o: (o.start < s.end) & (s.start < o.end)),
    )
    return found.withColumn(f"{SECRET}_spans", alone)


def written(kind: str) -> Column:
    """Spans of a kind as texts ``kind:start:end``."""
    return F.transform(f"{kind}_spans", lambda s: F.concat_ws(":", F.lit(kind), s.start, s.end))


def masked(found: DataFrame, text: str = "text", output: str = "masked") -> DataFrame:
    """Add the text with every span replaced by its kind in brackets.

    Of overlapping spans the earlier, and then the longer one is replaced.
    """

    def places(kind: str) -> Column:
        return F.transform(
            f"{kind}_spans", lambda s: F.struct(s.start.alias("start"), (-s.end).alias("back"), F.lit(kind).alias("kind"))
        )

    spans = F.array_sort(F.concat(*[places(kind) for kind in (*KINDS, SECRET)]))
    whole = F.coalesce(F.col(text), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("said"))

    def step(done: Column, s: Column) -> Column:
        said = F.concat(done.said, F.substring(whole, done.at + 1, s.start - done.at), F.lit("["), s.kind, F.lit("]"))
        return F.when(s.start < done.at, done).otherwise(F.struct((-s.back).alias("at"), said.alias("said")))

    rest = F.aggregate(
        spans, start, step, lambda done: F.concat(done.said, F.substring(whole, done.at + 1, F.char_length(whole)))
    )
    return found.withColumn(output, rest)
