"""Operator 9: chat formatting.

A turn's content is a list of typed parts. A visitor goes through them in order:
text is kept, an image, an audio clip or a document becomes a numbered placeholder,
and its reference is recorded with the number of tokens that it expands to.

The template marks turns with control strings that begin with ``<|``. In texts and
roles, every ``<`` that backslashes and ``|`` follow gets one more backslash, so no
text can hold a control string, and taking one backslash away gives the text back.

Turns are formatted row by row and numbered in their order. ``format_stretches`` puts
together at most ``STRETCH`` of them in a row, whatever their turns say, and
``conversation_digests`` reads sorted turns as a stream and holds one of them at a
time, so neither needs a conversation in memory. Only ``format_conversations`` makes
one value of a conversation, for those that a row can hold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns that are put together first.
STRETCH = 64
#: Tokens that parts expand to (fixed values): an image per tile of 512 by 512 pixels,
#: audio per second, a document per page; one unit where the size is unknown.
EXPANSION = {"image": 256, "audio": 25, "document": 600}
TILE = 512

PART = (
    "struct<type:string,text:string,uri:string,width:bigint,height:bigint,"
    "seconds:double,pages:bigint>"
)
ESCAPED = re.compile(r"<\\(\\*)\|")
TURN = re.compile(r"<\|turn\|>(.*?)\n(.*?)<\|end\|>\n", re.DOTALL)


def text_part(text: Column) -> Column:
    """Plain text as a list of one part."""
    nothing = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            nothing.cast("string").alias("uri"),
            nothing.cast("bigint").alias("width"),
            nothing.cast("bigint").alias("height"),
            nothing.cast("double").alias("seconds"),
            nothing.cast("bigint").alias("pages"),
        )
    )


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role stands on one line: line breaks and backslashes are written out."""
    written = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(written)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


class _Visitor:
    """What each type of part turns into; unknown types are named, not dropped."""

    def units(self, part: Column, kind: str) -> Column:
        if kind == "image":
            tiles = F.ceil(part.width / TILE) * F.ceil(part.height / TILE)
            size = F.coalesce(tiles, F.lit(1))
        elif kind == "audio":
            size = F.coalesce(F.ceil(part.seconds), F.lit(1))
        else:
            size = F.coalesce(part.pages, F.lit(1))
        return F.greatest(size, F.lit(1)).cast("bigint")

    def tokens(self, part: Column) -> Column:
        found = F.lit(0).cast("bigint")
        for kind, each in EXPANSION.items():
            found = F.when(part.type == kind, self.units(part, kind) * each).otherwise(found)
        return found

    def flat(self, part: Column, number: Column) -> Column:
        place = F.concat(
            F.lit("<|"), F.coalesce(escaped_role(part.type), F.lit("unknown")), F.lit(":"), number.cast("string"), F.lit("|>")
        )
        return F.when(part.type == "text", F.coalesce(escaped(part.text), F.lit(""))).otherwise(place)


def flatten(content: Column) -> tuple[Column, Column]:
    """The flattened text of a list of parts, and its attachments in order."""
    visitor = _Visitor()
    parts = F.coalesce(content, F.array().cast(f"array<{PART}>"))
    text = F.array_join(F.transform(parts, lambda p, i: visitor.flat(p, i)), "")
    attachments = F.filter(
        F.transform(
            parts,
            lambda p, i: F.struct(
                i.alias("number"), p.type.alias("type"), p.uri.alias("uri"), visitor.tokens(p).alias("tokens")
            ),
        ),
        lambda a: ~F.coalesce(a.type == "text", F.lit(False)),
    )
    return text, attachments


def _formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|turn|>"), role, F.lit("\n"), text, F.lit("<|end|>\n"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content) with ``formatted`` and ``attachments`` added."""
    text, attachments = flatten(F.col("content"))
    role = escaped_role(F.coalesce(F.col("role"), F.lit("")))
    return turns.withColumns({"formatted": _formatted(role, text), "attachments": attachments})


def _ordered_by(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, attachments), escaped: the columns that turns are ordered by."""
    text, attachments = flatten(F.col("content"))
    return turns.select(
        "conv_id",
        F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"),
        escaped_role(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
        text.alias("text"),
        attachments.alias("attachments"),
    )


def format_stretches(turns: DataFrame) -> DataFrame:
    """(conv_id, stretch, formatted, attachments): conversations in pieces of bounded rows.

    Input: conv_id, turn, role and content (a list of parts); other columns are left
    out. Turns stand in order of turn (null first); equal turns by role and text, so
    repeated rows are kept and the order is the same on every run. A null role or
    text is an empty one. Rows without conv_id make up one conversation of id null.
    Stretches count from 0 and hold ``STRETCH`` turns by number of row; their texts
    one after the other are the formatted conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "attachments")
    ordered = _ordered_by(turns).withColumn("number", F.row_number().over(order) - 1)
    ordered = ordered.withColumn("formatted", _formatted(F.col("role"), F.col("text")))
    stretches = ordered.groupBy("conv_id", F.floor(F.col("number") / STRETCH).alias("stretch")).agg(
        F.array_sort(F.collect_list(F.struct("number", "turn", "formatted", "attachments"))).alias("rows")
    )
    return stretches.select(
        "conv_id",
        "stretch",
        F.array_join(F.transform("rows", lambda r: r.formatted), "").alias("formatted"),
        F.flatten(F.transform("rows", lambda r: F.transform(r.attachments, lambda a: F.struct(r.turn.alias("turn"), a.number, a.type, a.uri, a.tokens)))).alias("attachments"),
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: its formatted text, attachments and expanded tokens.

    Input and order as in ``format_stretches``. A conversation is one value here, at
    most 2 GB; for longer ones there are the stretches.
    """
    part = F.struct("stretch", "formatted", "attachments")
    whole = format_stretches(turns).groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    attachments = F.flatten(F.col("parts.attachments"))
    return whole.select(
        "conv_id",
        F.array_join(F.col("parts.formatted"), "").alias("formatted"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda total, a: total + a.tokens).alias("attachment_tokens"),
    )


def turns_of(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text and span of the text (code points) of each turn."""
    return [
        (unescaped_role(m[1]), unescaped(m[2]), m.start(2), m.end(2)) for m in TURN.finditer(formatted)
    ]


def loss_spans(formatted: str) -> list[tuple[int, int]]:
    """Where the loss counts: the text of assistant turns, without control strings."""
    return [(start, end) for role, _, start, end in turns_of(formatted) if role == "assistant"]


READ_BACK = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Reading:
    """What formatted text says of its turns and its loss mask, read piece by piece."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str) -> None:
        """One or more whole turns."""
        for role, text, _, _ in turns_of(formatted):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        for start, end in loss_spans(formatted):
            text = unescaped(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "replace"))
        self.chars += len(formatted)

    def found(self) -> tuple:
        return self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(formatted: str) -> tuple:
    reading = _Reading()
    reading.add(formatted)
    return reading.found()


def _fields() -> list[str]:
    return [field.split()[0] for field in READ_BACK.split(", ")]


def read_back() -> Callable[[Column], Column]:
    """What the formatted text itself says of its turns and its loss mask."""

    @F.pandas_udf(READ_BACK)
    def of(formatted: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_read(x) for x in formatted], columns=_fields())

    return of


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation; its turns come one after the other."""
    names, done, reading = ["conv_id", *_fields()], [], None
    own, kind = None, pa.null()

    def rows() -> pa.RecordBatch:
        values = [pa.array([r[0] for r in done], kind)]
        for k in range(1, len(names)):
            values.append(pa.array([r[k] for r in done], pa.string() if names[k].endswith("sha256") else pa.int64()))
        return pa.RecordBatch.from_arrays(values, names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for i in range(batch.num_rows):
            conv_id = batch.column("conv_id")[i].as_py()
            if reading is None or conv_id != own:
                if reading is not None:
                    done.append((own, *reading.found()))
                own, reading = conv_id, _Reading()
            reading.add(batch.column("formatted")[i].as_py())
        if done:
            yield rows()
            done = []
    if reading is not None:
        done.append((own, *reading.found()))
        yield rows()


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``read_back`` of every formatted conversation, without putting it together.

    Input and order as in ``format_stretches``. The turns of a conversation are sorted
    within one partition, since a digest takes them one after the other; the sort
    spills to disk, and the stream holds one batch.
    """
    ordered = _ordered_by(turns).drop("attachments").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    formatted = _formatted(F.col("role"), F.col("text")).alias("formatted")
    return ordered.select("conv_id", formatted).mapInArrow(_digests, f"conv_id {kind}, {READ_BACK}")
