"""Operator 8: benchmark decontamination.

All windows of all benchmark items go into one Aho-Corasick automaton over word
numbers. A document is normalised to words and scanned once; what the automaton
finds is mapped back to words and, on request, to code points of the text.

The automaton is built in each worker from the items, which are sent as a broadcast.
Their size is checked first: beyond ``block_bytes`` the items are dealt into blocks
by a hash of their words, each block has an automaton of its own that scans all
documents, and what the blocks find is put together by document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of an item that count as a leak if they follow each other in a document.
WINDOW = 10
#: Bytes of item text in one automaton.
BLOCK_BYTES = 8 << 20

#: A-Z become a-z; what is no ASCII letter, no digit and not beyond ASCII, a blank.
NORMAL = bytes(
    b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
#: The same words, found in a text whose A-Z are still there.
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")

FOUND = "n_words bigint, hits array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(NORMAL).split()


class Leaks:
    """The automaton over the windows of (item id, text) pairs."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                windows.setdefault(ids[at : at + size], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, found in windows.items():
            self.automaton.add_word(ids, (len(ids), frozenset(found)))
        self.least = min(map(len, windows), default=0)
        if windows:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Numbers of the words inside windows, and the items found."""
        items: set[str] = set()
        if not self.least or len(words) < self.least:
            return [], items
        number = self.numbers.get
        inside = np.zeros(len(words), bool)
        for end, (size, found) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            inside[end - size + 1 : end + 1] = True
            items |= found
        return (np.flatnonzero(inside).tolist() if items else []), items


_built: dict[int, Leaks] = {}


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items as lists of bounded size; equal texts are in one block."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = int(total // block_bytes) + 1
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [tuple(row) for row in own.collect()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``hits`` (numbers of the words inside windows, ascending) and
    ``items`` (ids as strings, sorted) to each document; such columns are replaced.

    An item with fewer words than the window is one window; one without words is
    none. A null text has no words. An item without an id counts under the empty id.
    Repeated items count once, repeated documents are scanned each. Without any item
    there are no hits.
    """
    context = docs.sparkSession.sparkContext
    found = docs.drop("n_words", "hits", "items")
    before: list[str] = []
    for number, items in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        sent = context.broadcast((hash(tuple(items)), items))
        found = found.withColumn(f"found__{number}", _scan(sent, window)(F.col(text)))
        before.append(f"found__{number}")
    hits = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(c).hits for c in before]))))
    names = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(c)["items"] for c in before]))))
    one = F.col(before[0])
    return found.withColumns(
        {
            "n_words": one.n_words,
            "hits": hits if len(before) > 1 else one.hits,
            "items": names if len(before) > 1 else one["items"],
        }
    ).drop(*before)


def _scan(sent, window: int):
    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        key, items = sent.value
        if (key, window) not in _built:
            if len(_built) > 1:
                _built.clear()
            _built[key, window] = Leaks(items, window)
        leaks, rows = _built[key, window], []
        for text in texts:
            words = words_of(text)
            inside, names = leaks.scan(words)
            rows.append((len(words), inside, sorted(names)))
        return pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    return scan


def with_spans(found: DataFrame, text: str = "text", output: str = "spans") -> DataFrame:
    """Add the hit stretches of each text: (start, end) in code points, end exclusive."""

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def spans(texts: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([_spans(t, h) for t, h in zip(texts, hits, strict=True)], dtype=object)

    return found.withColumn(output, spans(F.col(text), F.col("hits")))


def _spans(text: str | None, hits) -> list[dict[str, int]]:
    if hits is None or not len(hits):
        return []
    places = [m.span() for m in WORD.finditer(text or "")]
    found: list[dict[str, int]] = []
    for before, at in zip([-2, *hits], hits):
        if at == before + 1:
            found[-1]["end"] = places[at][1]
        else:
            found.append({"start": places[at][0], "end": places[at][1]})
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that hold no window of any item, with their own columns only."""
    marked = docs.withColumn("doc__", F.struct(*[F.col(c) for c in docs.columns]))
    found = find_leaks(marked, benchmark, **options).where(F.size("hits") == 0)
    return found.select([F.col("doc__")[c].alias(c) for c in docs.columns])
