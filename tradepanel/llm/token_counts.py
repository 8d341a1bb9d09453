"""Operator 10: token counts at every prefix.

``count[i]`` of a piece is the number of BPE tokens of its first i bytes. It follows
from a shorter prefix: the tokens of prefix i are those of some prefix j and one
token from j to i, for the one j at which that token can stand after the last token
of prefix j. Two tokens can stand side by side if no merge of a symbol at the end of
the first with one at the start of the second comes before the merges that build the
two: merges happen in order of rank, so both edges are walked by rank.

A text's counts are those of its pieces, added up. Budgets and truncations are read
from the stored counts; no text is encoded again. No shuffle; each worker keeps the
counts of pieces in a table of bounded size.
"""

from __future__ import annotations

import re
from itertools import accumulate, chain

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bounded, file_bytes
from .tokenizer_files import WHITE_SPACE, TokenizerFile

KEPT_WORDS = 300_000
KEPT_TOTALS = 1_000_000
KEPT_CHARS = 64
#: Parts of contractions that are no piece of their own (from the fixed pattern).
CUT_CONTRACTIONS = ("'r", "'v", "'l")


class PrefixCounter:
    def __init__(self, content: bytes):
        self.file = TokenizerFile(content)
        code = {letter: byte for byte, letter in enumerate(self.file.letters)}
        #: symbol as bytes -> id
        self.tokens = {bytes(map(code.__getitem__, s)): i for s, i in self.file.ids.items()}
        self.longest = max(map(len, self.tokens))
        self.built = {joined: (rank, *pair) for pair, (rank, joined) in self.file.merges.items()}
        self.piece = regex.compile(self.file.pattern)
        self.chunk = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
        self.right_edges: dict[int, list[tuple[int, int]]] = {}
        self.left_edges: dict[int, list[tuple[int, int]]] = {}
        self.apart = Bounded(lambda pair: self.beside(*pair), KEPT_WORDS)
        self.chunks = Bounded(self._chunk_counts, KEPT_WORDS)
        self.totals = Bounded(self._chunk_total, KEPT_TOTALS)
        self.pieces = Bounded(self._piece_counts, KEPT_WORDS)

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int]]:
        """Symbols at one edge of a token while it is built, and the rank that ends each."""
        if token not in known:
            made = self.built.get(token)
            if made is None:
                known[token] = [(token, len(self.built))]
            else:
                inner = self._edge(made[side], side, known)
                known[token] = [*inner[:-1], (inner[-1][0], made[0]), (token, len(self.built))]
        return known[token]

    def beside(self, first: int, second: int) -> bool:
        """Whether BPE leaves these two tokens apart."""
        left = self._edge(first, 2, self.right_edges)
        right = self._edge(second, 1, self.left_edges)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            merge = self.file.merges.get((a, b))
            # of two equal pairs the left one is merged first
            if merge and merge[0] < a_ends and merge[0] <= b_ends:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def byte_counts(self, data: bytes) -> list[int]:
        """Tokens of each prefix of a piece, by bytes.

        Only one token can end a prefix, so the order of trials is free: first the
        token that ended the prefix before, made longer, then later starts, then
        earlier ones.
        """
        counts, last, begun = [0], [-1], 0
        token_of, apart = self.tokens.get, self.apart
        for end in range(1, len(data) + 1):
            token = token_of(data[begun:end])
            if token is not None and (begun == 0 or apart[last[begun], token]):
                counts.append(counts[begun] + 1)
                last.append(token)
                continue
            for start in chain(range(begun + 1, end), range(begun - 1, max(0, end - self.longest) - 1, -1)):
                token = token_of(data[start:end])
                if token is not None and (start == 0 or apart[last[start], token]):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    begun = start
                    break
            else:
                raise ValueError(f"no token ends {data[:end]!r}")
        return counts

    def _piece_counts(self, piece: str) -> tuple[int, ...]:
        """Tokens of each prefix of a piece, by code points."""
        data = piece.encode("utf-8", "replace")
        counts = self.byte_counts(data)
        if len(data) != len(piece):
            counts = [0] + [counts[at] for at in accumulate(len(c.encode("utf-8", "replace")) for c in piece)]
        if piece[:2] in CUT_CONTRACTIONS and len(piece) == 3:
            counts[2] = 2
        return tuple(counts)

    def _chunk_counts(self, chunk: str) -> tuple[int, ...]:
        counts = [0]
        for piece in self.piece.findall(chunk):
            before = counts[-1]
            counts += [before + n for n in self._piece(piece)[1:]]
        return tuple(counts)

    def _chunk_total(self, chunk: str) -> int:
        return sum([self._piece(piece)[-1] for piece in self.piece.findall(chunk)])

    def _piece(self, piece: str) -> tuple[int, ...]:
        return self.pieces[piece] if len(piece) <= KEPT_CHARS else self._piece_counts(piece)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        return self.chunks[chunk] if len(chunk) <= KEPT_CHARS else self._chunk_counts(chunk)

    def total(self, text: str) -> int:
        """Tokens of a whole text."""
        count = 0
        for at, part in enumerate(self.file.parts(text)):
            if at % 2:
                count += 1
                continue
            chunks = self.chunk.findall(part)
            if len(part) > KEPT_CHARS * len(chunks):
                count += sum([self.totals[c] if len(c) <= KEPT_CHARS else self._chunk_total(c) for c in chunks])
            else:
                count += sum(map(self.totals.__getitem__, chunks))
        return count

    def prefixes(self, text: str) -> list[int]:
        """Tokens of each prefix of a text, by code points, from the empty one on.

        A prefix that ends in white space ends in a run that is a piece of its own,
        and one that ends in a special string has only a part of it: both are
        counted from the start of the run or of the string's chunk.
        """
        counts, parts = [0], self.file.parts(text)
        for at, part in enumerate(parts):
            if at % 2:
                tail = part if at < 1 else self._last_chunk(parts[at - 1]) + part
                before = counts[len(counts) - 1 - (len(tail) - len(part))]
                whole = counts[-1] + 1
                for size in range(len(tail) - len(part) + 1, len(tail)):
                    counts.append(before + sum(self._chunk(c)[-1] for c in self.chunk.findall(tail[:size])))
                counts.append(whole)
                continue
            run_start, run_base = -1, 0  # of the white space that the prefix ends in
            position, start = 0, len(counts) - 1
            for chunk in self.chunk.findall(part):
                base = counts[-1] if position == 0 else ended
                known = self._chunk(chunk)
                for size, char in enumerate(chunk, 1):
                    if self._blank(char):
                        if run_start < 0:
                            run_start, run_base = position, base + known[size - 1]
                        run = part[run_start : position + 1]
                        counts.append(run_base + self._chunk(run)[-1])
                    else:
                        run_start = -1
                        counts.append(base + known[size])
                    position += 1
                ended = base + known[-1]
            assert len(counts) == start + len(part) + 1
            if part:
                counts[-1] = ended
        return counts

    def _blank(self, char: str) -> bool:
        return char.isspace() and not "\x1c" <= char <= "\x1f"

    def _last_chunk(self, part: str) -> str:
        chunks = self.chunk.findall(part)
        tail = chunks[-1] if chunks else ""
        if tail and len(chunks) > 1 and not self._blank(tail[-1]) and tail[0] == " " and self._blank(chunks[-2][-1]):
            tail = chunks[-2] + tail
        return tail


_counters: dict[int, PrefixCounter] = {}


def counter(content: bytes) -> PrefixCounter:
    key = hash(content)
    if key not in _counters:
        _counters[key] = PrefixCounter(content)
    return _counters[key]


def token_counts(df: DataFrame, path: str, text: str = "text", output: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text; 0 for a null or an empty one.

    A column of that name is replaced. Rows stay as they are.
    """
    sent = df.sparkSession.sparkContext.broadcast(file_bytes(path))

    @F.pandas_udf("bigint")
    def total(texts: pd.Series) -> pd.Series:
        one = counter(sent.value)
        return pd.Series([one.total(x or "") for x in texts], dtype="int64")

    return df.withColumn(output, total(F.col(text)))


def prefix_counts(df: DataFrame, path: str, text: str = "text", output: str = "prefix_counts") -> DataFrame:
    """Add the stored counts: element i (from 0) for the first i code points.

    A null or empty text has the one element 0.
    """
    sent = df.sparkSession.sparkContext.broadcast(file_bytes(path))

    @F.pandas_udf("array<int>")
    def stored(texts: pd.Series) -> pd.Series:
        one = counter(sent.value)
        return pd.Series([one.prefixes(x or "") for x in texts], dtype=object)

    return df.withColumn(output, stored(F.col(text)))


def tokens_before(counts: Column | str, position: Column | int) -> Column:
    """Tokens of the first ``position`` code points; of all if there are fewer."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    position = F.lit(position) if isinstance(position, int) else position
    return F.get(counts, F.least(position, F.size(counts) - 1))


def longest_prefix(counts: Column | str, budget: Column | int) -> Column:
    """Code points of the longest prefix within a budget of tokens.

    Counts may fall from one prefix to the next, so the last one that fits is
    taken. A budget below 0 allows none: the result is null.
    """
    counts = F.col(counts) if isinstance(counts, str) else counts
    budget = F.lit(budget) if isinstance(budget, int) else budget
    return F.array_max(
        F.filter(F.transform(counts, lambda n, i: F.when(n <= budget, i)), lambda i: i.isNotNull())
    )
