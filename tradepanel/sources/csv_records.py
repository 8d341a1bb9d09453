"""CSV records with line breaks inside quotes, read by many tasks.

A record may span lines, so a task that starts in the middle of a file cannot tell by
itself whether its first line continues one. It can count quotes, though:

1. Splits are cut into blocks of lines. Every block gives the parity of its quotes and the
   place of its last line that starts a record, if it starts outside quotes or if it starts
   inside. That is one short row a block.
2. A running XOR over the blocks of a file, in order, says how each one starts, and a
   running maximum where the record began that it starts in.
3. Within its block, every line then knows whether it starts a record. Only the lines of
   records that span several are brought together, by record.

A task sorts the lines of blocks, not of splits, so its memory does not follow the size of
a split, and splits whose hashes meet do not add up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LATIN1 = "ISO-8859-1"
#: A block has at most two to this power of lines.
BLOCK_BITS = 14


def byte_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, at, value): the lines of files as bytes, by splits.

    ``at`` orders the lines of a file: the start of the split, then an id that follows
    the order in which a task reads.
    """
    return byte_lines_of(spark.read.text(paths))


def byte_lines_of(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")
        ).alias("at"),
        "value",
    )


def odd_quotes(line: Column) -> Column:
    """Whether a line has an odd number of quotes. They are counted in bytes, since the
    lines of a Latin-1 file are not text yet."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def marked_lines(lines: DataFrame) -> DataFrame:
    """Add ``opens``: where the record of a line starts, ``spans``: whether that record
    has several lines, and ``first``: whether it is the first line of its file."""
    block = ["file", "start", "block"]
    rows = lines.withColumns({"odd": odd_quotes(F.col("value")), "start": F.col("at.start"), "block": F.shiftright("at.line", BLOCK_BITS)})
    in_order = Window.partitionBy(*block).orderBy("at")
    before, so_far = (in_order.rowsBetween(Window.unboundedPreceding, last) for last in (-1, Window.currentRow))
    rows = rows.withColumn("turned", F.coalesce(F.sum(F.col("odd").cast("int")).over(before) % 2, F.lit(0)))
    # Of a block that starts outside quotes (0) and of one that starts inside (1).
    starts = {state: F.when(F.col("turned") == state, F.col("at")) for state in (0, 1)}
    blocks = rows.groupBy(*block).agg(
        (F.sum(F.col("odd").cast("int")) % 2).alias("parity"), F.min("at").alias("lowest"),
        *[F.max(at).alias(f"last_{state}") for state, at in starts.items()],
    )
    by_place = Window.partitionBy("file").orderBy("start", "block")
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("parity").over(earlier) % 2, F.lit(0)))
    own_last = F.when(F.col("inside") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    head = F.when((F.row_number().over(by_place) == 1) & (F.col("start") == 0), F.col("lowest"))
    blocks = blocks.withColumns({"carried": F.max(own_last).over(earlier), "head": head}).select(*block, "inside", "carried", "head")
    rows = rows.withColumns({f"opens_{state}": F.max(at).over(so_far) for state, at in starts.items()}).join(blocks, block)
    opens = F.coalesce(F.when(F.col("inside") == 0, F.col("opens_0")).otherwise(F.col("opens_1")), F.col("carried"))
    whole = (F.col("turned") == F.col("inside")) & ~F.col("odd")  # an even number of quotes before and in the line
    rows = rows.withColumns({"opens": opens, "spans": ~whole, "first": F.coalesce(F.col("head") == F.col("at"), F.lit(False))})
    return rows.select("file", "at", "opens", "spans", "first", "value")


def records(spark: SparkSession, paths, encoding: str = "UTF-8") -> DataFrame:
    """(file, at, record): every record of CSV files but the first, which is the header.

    Line breaks inside quotes come back as a line feed, blank lines between records are
    left out. Headers of several lines, and files whose quotes do not pair up, must not
    come here: their records cannot be told apart.
    """
    marked = marked_lines(byte_lines(spark, paths)).where(~F.col("first"))
    value = F.col("value") if encoding != LATIN1 else F.decode(F.col("value").cast("binary"), LATIN1)
    rows = marked.select("file", "at", "opens", "spans", value.alias("value"))
    single = rows.where(~F.col("spans")).select("file", "at", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("at", "value")))
    several = rows.where("spans").groupBy("file", "opens").agg(F.array_join(parts.getField("value"), "\n").alias("record"))
    found = single.unionByName(several.select("file", F.col("opens").alias("at"), "record"))
    return found.where(F.trim("record") != "")
