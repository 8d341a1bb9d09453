"""Operator 12: periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch with smallest period q, at least ``EXPONENT`` periods and ``LEAST``
words long, that cannot be extended.

1. Suffix links of the automaton of a text form a tree in which the path from the root
   to the state of a prefix holds all its suffixes. Appending a word accesses that path
   and colours it with the new end. Before that, it falls into segments of one colour
   each: suffixes that were last seen at the same end.
2. If such a segment was seen q words ago and holds the suffix of length q, then that
   suffix and the one before it are equal, with no other occurrence in between: a square
   of smallest period q ends here.
3. A square is extended to both sides as far as the period holds, which gives the run.

Paths are kept as the heavy paths of the tree, each with a stack of coloured segments
from its top; an access takes what it covers off the stacks. A path of any depth crosses
a logarithmic number of heavy paths, and each access adds one segment to each.

The automaton reads only those parts of a text that can hold a run: in a run of period
q, every group of words from the second period on has occurred within the last q words,
so a run needs a long stretch of such groups. That holds for all runs and needs two
sorts; it decides nothing else. Texts are independent rows, so there is no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words and so many periods.
LEAST, EXPONENT = 6, 4
#: Words in a group, and the longest period for which single words are looked at.
GROUP, SHORT = 8, 8


class Run(NamedTuple):
    start: int
    length: int
    period: int


class SuffixAutomaton:
    """Of a sequence of numbers: ``length`` and ``link`` by state, ``ends`` by prefix."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.ends = [0], [-1], []
        moves: list[dict[int, int]] = [{}]
        length, link, last = self.length, self.link, 0
        for word in words:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            moves.append({})
            at = last
            while at >= 0 and word not in moves[at]:
                moves[at][word] = new
                at = link[at]
            if at >= 0:
                seen = moves[at][word]
                if length[seen] == length[at] + 1:
                    link[new] = seen
                else:
                    copy = len(length)
                    length.append(length[at] + 1)
                    link.append(link[seen])
                    moves.append(moves[seen].copy())
                    link[seen] = link[new] = copy
                    while at >= 0 and moves[at].get(word) == seen:
                        moves[at][word] = copy
                        at = link[at]
            self.ends.append(new)
            last = new


class ColouredPaths:
    """Paths to the root of a suffix link tree, coloured by the last access.

    ``heads`` has the top of each state's heavy path, ``stacks`` the segments of a heavy
    path that are coloured, the one at the top last, as (length at its lower end, colour).
    """

    def __init__(self, automaton: SuffixAutomaton):
        self.length, self.link = automaton.length, automaton.link
        size = len(self.link)
        order = np.argsort(self.length, kind="stable").tolist()
        weight = [1] * size
        for state in reversed(order[1:]):
            weight[self.link[state]] += weight[state]
        heavy = [-1] * size
        for state in order[1:]:
            above = self.link[state]
            if heavy[above] < 0 or weight[state] > weight[heavy[above]]:
                heavy[above] = state
        self.heads = list(range(size))
        for state in order[1:]:
            above = self.link[state]
            if heavy[above] == state:
                self.heads[state] = self.heads[above]
        self.stacks: dict[int, list[tuple[int, int]]] = {}

    def access(self, state: int, colour: int) -> list[tuple[int, int, int]]:
        """Colour the path from the root; what it was, as (above, length, colour).

        A segment holds the suffixes longer than ``above``, up to ``length``. Suffixes
        that were never seen are in none.
        """
        found, length, link = [], self.length, self.link
        while state > 0:
            head, reach = self.heads[state], length[state]
            top = length[link[head]] if link[head] >= 0 else 0
            stack = self.stacks.setdefault(head, [])
            above = top
            while stack and above < reach:
                lower, old = stack[-1]
                if lower <= reach:
                    stack.pop()
                    found.append((above, lower, old))
                else:
                    found.append((above, reach, old))
                above = lower
            stack.append((reach, colour))
            state = link[head]
        return found


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of every square whose half is no power of a shorter sequence."""
    automaton = SuffixAutomaton(words)
    paths = ColouredPaths(automaton)
    for end, state in enumerate(automaton.ends):
        for above, length, seen in paths.access(state, end):
            if above < end - seen <= length:
                yield end, end - seen


def _equal_steps(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on, going by ``step``, equal those a period before."""
    room = len(words) - at if step > 0 else at - period + 1
    done, size = 0, 16
    while done < room:
        size = min(size, room - done)
        if step > 0:
            differ = words[at + done : at + done + size] != words[at + done - period : at + done + size - period]
        else:
            high = at - done + 1
            differ = (words[high - size : high] != words[high - size - period : high - period])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done += size
        size *= 2
    return done


def last_seen(values: np.ndarray) -> np.ndarray:
    """How far back the same value was last; the number of values where never."""
    order = np.argsort(values, kind="stable")
    back = np.full(len(values), len(values), np.int64)
    same = values[order][1:] == values[order][:-1]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    return back


def grouped(words: np.ndarray) -> np.ndarray:
    """A hash of each group of ``GROUP`` words, at its last one. Equal groups have equal
    hashes; that others may too can only add to what is looked at."""
    total = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    reach = 1
    while reach < GROUP:
        total = total[reach:] + (total[:-reach] ^ (total[:-reach] >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        reach *= 2
    return total


def parts(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches, first and after the last word, that hold all runs of the text.

    A run of period q has at least 3 q - k + 1 groups of k words after one another that
    were each seen within the last q words. Periods are taken by powers of two: above
    half of ``most`` and up to it.
    """
    size, found = len(words), []
    most, back, group = 1, last_seen(words), 1
    while EXPONENT * (most // 2 + 1) <= size:
        if most > SHORT and group == 1:
            if size < GROUP:
                break
            back, group = last_seen(grouped(words)), GROUP
        least = most // 2 + 1
        stretch = max(LEAST, EXPONENT * least) - least - group + 1
        near = np.flatnonzero(np.diff(np.concatenate([[False], back <= most, [False]])))
        near = near.reshape(-1, 2)[np.diff(near)[::2] >= stretch]
        found += [(max(0, a - most), b + group - 1) for a, b in near.tolist()]
        most *= 2
    joined: list[tuple[int, int]] = []
    for first, after in sorted(found):
        if joined and first <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(joined[-1][1], after)
        else:
            joined.append((first, after))
    return joined


def runs(words: np.ndarray) -> list[Run]:
    """All runs of a sequence of numbers, by start and then period."""
    found: set[Run] = set()
    for first, after in parts(words):
        reached: dict[int, int] = {}
        for at, period in squares(words[first:after].tolist()):
            end = at + first
            if end < reached.get(period, 0):
                continue
            after_run = end + 1 + _equal_steps(words, end + 1, period, 1)
            start = end - 2 * period + 1 - _equal_steps(words, end - period, period, -1)
            reached[period] = after_run
            if after_run - start >= max(LEAST, EXPONENT * period):
                found.add(Run(start, after_run - start, period))
    return sorted(found, key=lambda run: (run.start, run.period))


def split_words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))


def kept_words(size: int, found: list[Run]) -> np.ndarray:
    """The places of words that no run contains after its first period."""
    edges = np.zeros(size + 1, np.int64)
    for run in found:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    return np.flatnonzero(np.cumsum(edges[:-1]) == 0)


OUTPUTS = {
    "n_words": "bigint",
    "starts": "array<bigint>",
    "lengths": "array<bigint>",
    "periods": "array<bigint>",
    "collapsed": "string",
    "collapsed_sha256": "string",
}


def _outputs(text: bytes | None, wanted: tuple[str, ...]) -> list:
    words = split_words(text)
    found = runs(numbered(words))
    row: dict = {"n_words": len(words)}
    row["starts"], row["lengths"], row["periods"] = zip(*found, strict=True) if found else ((), (), ())
    if "collapsed" in wanted or "collapsed_sha256" in wanted:
        kept = b" ".join([words[i] for i in kept_words(len(words), found).tolist()] if found else words)
        row["collapsed"] = kept.decode("utf-8", "replace")
        row["collapsed_sha256"] = hashlib.sha256(kept).hexdigest()
    return [row[name] for name in wanted]


def periodic_runs(df: DataFrame, text: str = "text", outputs: tuple[str, ...] = ("runs", "collapsed")) -> DataFrame:
    """Add ``runs`` and what else is asked for; a column of such a name is replaced.

    ``runs`` is an array of (start, length, period) in words, by start and then period.
    ``collapsed`` has the words that no run contains after its first period, joined by
    one space; ``collapsed_sha256`` is its digest and ``n_words`` counts all words.
    Words are what ASCII white space parts; case counts. A null, empty or blank text has
    no words, no runs and an empty ``collapsed``. Rows stay as they are, repeated ones
    too; an empty table gives an empty one.
    """
    wanted = tuple(name for name in OUTPUTS if name in outputs or "runs" in outputs and name in ("starts", "lengths", "periods"))

    def of_texts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_outputs(x, wanted) for x in texts], columns=list(wanted))

    schema = ", ".join(f"{name} {OUTPUTS[name]}" for name in wanted)
    # Else the optimiser moves the function into the expressions that use its result.
    once = F.pandas_udf(of_texts, schema).asNondeterministic()
    found = df.withColumn("found__", once(F.col(text).cast("binary")))
    triples = F.arrays_zip(
        F.col("found__.starts").alias("start"), F.col("found__.lengths").alias("length"), F.col("found__.periods").alias("period")
    )
    values = {name: triples if name == "runs" else F.col(f"found__.{name}") for name in outputs}
    return found.withColumns(values).drop("found__")


def longest(found: Column) -> Column:
    """The run of greatest length; of equal ones that of smallest start, then period."""
    order = F.transform(found, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    most = F.array_max(order)
    return F.when(most.isNotNull(), F.struct((-most.start).alias("start"), most.length.alias("length"), (-most.period).alias("period")))


def as_lines(found: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(found, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
