"""Operator 3: BPE encoding and decoding.

A word starts as a doubly linked list of byte symbols. A priority queue holds every
adjacent pair that a merge names, by rank and then from the left. The lowest is
taken, joined if both its symbols are still what they were when it was queued (a
stale entry is skipped), and the pairs that the new symbol forms with its neighbours
are queued. A word of n bytes thus takes O(n log n), also one of many thousands.

Texts are independent rows, so there is no shuffle. Each worker keeps what it has
encoded in tables of bounded size; the vocabulary is one file, sent as a broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .common import BoundedBytes, file_bytes
from .tokenizer_files import WHITE_SPACE, TokenizerFile

#: Bytes of encoded words and chunks of text that a worker keeps, about; more of them
#: save time where a corpus has many different words.
KEPT_BYTES = 192 << 20
#: Bytes of text that are encoded before their results go on.
SLICE_BYTES = 2 << 20
#: Longer chunks are encoded anew each time.
KEPT_CHARS = 64

OUTPUTS = {
    "ids": "array<int>",
    "decoded": "string",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


class Encoder:
    """Encodes and decodes texts for a tokenizer file that drops white space."""

    def __init__(self, content: bytes, kept: int = KEPT_BYTES):
        self.file = TokenizerFile(content)
        self.word = regex.compile(self.file.pattern)
        self.blank = re.compile(f"[{WHITE_SPACE}]+")
        # About what Python takes for a key, its place in the table and its value.
        self.words = BoundedBytes(self._encode_word, kept // 4, lambda key, ids: 190 + len(key) + 30 * len(ids))
        self.chunks = BoundedBytes(
            self._encode_chunk, kept - kept // 4, lambda key, x: 270 + len(key) + len(x[1]) + len(x[2])
        )
        letters, end = self.file.letters, self.file.word_end
        self.first = [self.file.ids.get(x) for x in letters]
        self.last = [self.file.ids.get(x + end) for x in letters]

    def merge(self, ids: list[int]) -> list[int]:
        """Apply all merges to a list of symbols."""
        merges, size = self.file.merges, len(ids)
        before = list(range(-1, size - 1))
        after = [*range(1, size), -1]
        queue = [
            (merge[0], at, ids[at], ids[at + 1], merge[1])
            for at in range(size - 1)
            if (merge := merges.get((ids[at], ids[at + 1])))
        ]
        heapq.heapify(queue)
        while queue:
            _, at, left, right, joined = heapq.heappop(queue)
            gone = after[at]
            if gone < 0 or ids[at] != left or ids[gone] != right:
                continue
            ids[at], ids[gone] = joined, -1
            after[at] = later = after[gone]
            after[gone] = -1
            if later >= 0:
                before[later] = at
                if merge := merges.get((joined, ids[later])):
                    heapq.heappush(queue, (merge[0], at, joined, ids[later], merge[1]))
            earlier = before[at]
            if earlier >= 0 and (merge := merges.get((ids[earlier], joined))):
                heapq.heappush(queue, (merge[0], earlier, ids[earlier], joined, merge[1]))
        return [i for i in ids if i >= 0]

    def _encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "replace")
        ids = [self.first[byte] for byte in data[:-1]] + [self.last[data[-1]]]
        return self.merge([i for i in ids if i is not None])

    def _encode_chunk(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, ids and symbols, each joined by blanks."""
        words = self.word.findall(chunk)
        if len(words) == 1:  # kept as a chunk
            ids = self._encode_word(words[0])
        else:
            ids = []
            for word in words:
                ids += self.words[word] if len(word) <= KEPT_CHARS else self._encode_word(word)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encoded(self, text: str) -> list[tuple[int, str, str]]:
        """What ``_encode_chunk`` gives, for each part between white space."""
        found = []
        for at, part in enumerate(self.file.parts(text)):
            if at % 2:
                found.append((1, str(self.file.special[part]), part))
                continue
            chunks = [c for c in self.blank.split(self.normal(part)) if c]
            if sum(map(len, chunks)) > KEPT_CHARS * len(chunks):
                found += [
                    self.chunks[c] if len(c) <= KEPT_CHARS else self._encode_chunk(c)
                    for c in chunks
                ]
            else:
                found += map(self.chunks.__getitem__, chunks)
        return [x for x in found if x[0]]

    def decode(self, ids: Iterable[int]) -> str:
        """Vocabulary strings, concatenated as the file's decoder (or its absence) has it."""
        return self.file.joiner.join([self.file.symbols[i] for i in ids])


_encoders: dict[tuple, Encoder] = {}


def encoder(content: bytes, kept: int = KEPT_BYTES) -> Encoder:
    """One per worker and vocabulary, with the tables that it has filled."""
    key = hash(content), kept
    if key not in _encoders:
        _encoders[key] = Encoder(content, kept)
    return _encoders[key]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def _outputs(one: Encoder, text: str | None, wanted: tuple[str, ...]) -> tuple:
    found = one.encoded(text or "")
    joined = " ".join([x[1] for x in found])
    decoded = one.file.joiner.join([x[2] for x in found])
    make = {
        "ids": lambda: np.fromstring(joined, np.int32, sep=" "),
        "decoded": lambda: decoded,
        "n_tokens": lambda: sum([x[0] for x in found]),
        "ids_sha256": lambda: _sha256(joined),
        "decoded_sha256": lambda: _sha256(decoded),
    }
    return tuple(make[name]() for name in wanted)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of some MB of text (its last column), one row at least."""
    at, size = 0, 0
    for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column(-1)), 0).to_pylist()):
        if row > at and size + length > SLICE_BYTES:
            yield batch.slice(at, row - at)
            at, size = row, 0
        size += length
    if batch.num_rows:
        yield batch.slice(at)


def vocabulary(df: DataFrame, path: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(file_bytes(path))


def encode(
    df: DataFrame,
    path: str,
    outputs: Iterable[str] = ("ids",),
    text: str = "text",
    keep: Iterable[str] | None = None,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """Add what is asked for of ``OUTPUTS``; a column of such a name is replaced.

    A null text is an empty one: no ids, an empty decoded text. Rows stay as they
    are, repeated ones too, with all columns or those in ``keep``; an empty table gives
    an empty one. A worker holds one Arrow batch of texts, and of strings, ids and
    results those of a slice of it.
    """
    wanted, sent = tuple(outputs), vocabulary(df, path)
    kept = [name for name in (df.columns if keep is None else keep) if name not in wanted]
    # Columns go by number meanwhile: names may be anything, also that of another one here.
    columns = [F.col("`" + name.replace("`", "``") + "`").alias(f"c{i}") for i, name in enumerate(kept)]
    rows = df.select(*columns, F.col(text).cast("string").alias("text"))
    made = StructType.fromDDL(", ".join(f"{name} {OUTPUTS[name]}" for name in wanted))
    kinds = [to_arrow_type(field.dataType) for field in made]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(sent.value, kept_bytes)
        for batch in batches:
            for part in _slices(batch):
                values = zip(*[_outputs(one, x, wanted) for x in part.column(-1).to_pylist()], strict=True)
                added = [pa.array(list(x), kind) for x, kind in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *added], names=[*batch.schema.names[:-1], *wanted])

    found = rows.mapInArrow(of_batches, StructType([*rows.schema.fields[:-1], *made.fields]))
    return found.toDF(*kept, *wanted)


def decode(df: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add the text of a column of ids; null ids give an empty text."""
    sent = vocabulary(df, path)

    @F.pandas_udf("string")
    def of_ids(rows: pd.Series) -> pd.Series:
        one = encoder(sent.value)
        return pd.Series([one.decode(x if x is not None else ()) for x in rows], dtype=object)

    return df.withColumn(output, of_ids(F.col(ids)))
