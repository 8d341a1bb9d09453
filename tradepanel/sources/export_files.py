"""Raw export declarations from CSV files of mixed encodings and layouts."""

from __future__ import annotations

import csv
import re
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import COUNTRY_HEADER, FOB_HEADER, PRODUCT_HEADER, HeaderRule
from ..functions import cleaning as C
from ..operators.exports import canonical_names, distinct_names
from ..schemas import PROVENANCE_COLUMNS, all_text
from .csv_records import LATIN1, byte_lines, byte_lines_of, odd_quotes, records
from .tables import stored

UTF8 = "UTF-8"
CSV_FILES = "*.[cC][sS][vV]"
#: Of a record that has more or fewer fields than its header: the record as it was read,
#: the number of its fields and of those in the header. Null for all others.
MALFORMED = "_MALFORMED"
#: The name and the path of the file that a row is from.
SOURCE = ("SOURCE_FILE", "SOURCE_PATH")
_CSV = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession, paths, columns, encoding: str = UTF8, multi_line: bool = True,
    malformed: bool = False, source: bool = False,
) -> DataFrame:
    """Text columns by position, quotes doubled inside quoted fields.

    Any file is split among many tasks, also one in which quoted fields hold line breaks
    (``multi_line``); that takes a shuffle of its lines. Surplus fields are dropped and
    missing ones null; with ``malformed`` a column ``MALFORMED`` keeps such records, and
    with ``source`` two more say which file a record is from.
    """
    schema = all_text([*columns, MALFORMED] if malformed else columns)
    options = dict(_CSV)
    if malformed:
        options |= {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    if multi_line:
        fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
        found = records(spark, paths, encoding)
        found = found.select("file", F.from_csv("record", fields, options).alias("record"))
        values, names = [F.col("record.*")], [file_name(F.col("file")), F.col("file")]
    else:
        found = spark.read.schema(schema).options(header="true", encoding=encoding, **options).csv(paths)
        values, names = ["*"], [F.col("_metadata.file_name"), F.col("_metadata.file_path")]
    return found.select(*values, *[c.alias(name) for c, name in zip(names, SOURCE) if source])


def file_name(uri: Column) -> Column:
    """The last part of a file's URI, decoded."""
    return F.url_decode(F.replace(F.substring_index(uri, "/", -1), F.lit("+"), F.lit("%2B")))


def _holds(rule: HeaderRule, headers: Column) -> Column:
    """Whether one of the headers satisfies the rule."""
    def fits(header):
        holds = reduce(lambda a, b: a & b, [header.contains(w) for w in rule.words])
        if rule.one_of:
            holds = holds & reduce(lambda a, b: a | b, [header.contains(w) for w in rule.one_of])
        return holds

    return F.exists(headers, fits)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, modified) of the CSV files under a path; none of them is read. Empty
    files are left out, as Spark's readers do."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", CSV_FILES)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def header_fields(line: Column) -> Column:
    """The fields of a header line, upper-cased, without quotes and outer blanks."""
    fields = F.split(F.upper(line), r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    plain = lambda field: F.replace(F.regexp_replace(F.trim(field), '^"|"$', ""), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda field: F.trim(plain(field)))


def inspect_files(spark: SparkSession, path: str | None = None, files: list[str] | None = None) -> DataFrame:
    """Per file its header, encoding, layout, content and whether it is admitted.

    The lines are read as bytes by splits, so that large files are shared among
    tasks. A file is UTF-8 if all of its lines are; any other text is valid
    Latin-1. A field spans lines only if some line has an odd number of quotes.
    The first line is the lowest in the file's first split. ``content`` is made of sums
    of hashes of the lines, and so is the same for copies. ``reason`` says why a file is
    refused. Instead of a path, ``files`` names the files to read.
    """
    if files is not None and not files:
        lines = spark.createDataFrame([], "file string, at struct<start: bigint, line: bigint>, value string")
    elif files is not None:
        lines = byte_lines(spark, [readable_path(file) for file in files])
    else:
        reader = spark.read.option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true")
        lines = byte_lines_of(reader.text(path))
    odd = odd_quotes(F.col("value"))
    hashes = [F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(20,0)")) for seed in (0, 1)]
    found = lines.groupBy("file").agg(
        F.min_by("value", "at").alias("first_line"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(odd).alias("multi_line"),
        (F.sum(odd.cast("int")) % 2 == 0).alias("paired"),
        F.count("*").alias("lines"),
        F.concat_ws("-", F.count("*"), *hashes).alias("content"),
    )
    text = F.when(F.col("utf8"), F.col("first_line")).otherwise(
        F.decode(F.col("first_line").cast("binary"), LATIN1)
    )
    headers = header_fields(text)
    found = found.select(
        "file",
        text.alias("header"),
        F.when(F.col("utf8"), UTF8).otherwise(LATIN1).alias("encoding"),
        "multi_line",
        "lines",
        "content",
        _holds(FOB_HEADER, headers).alias("has_fob"),
        _holds(COUNTRY_HEADER, headers).alias("has_country"),
        _holds(PRODUCT_HEADER, headers).alias("has_product"),
        F.array_compact(
            F.array(
                F.when(~_holds(FOB_HEADER, headers), "no FOB column"),
                F.when(~_holds(COUNTRY_HEADER, headers), "no destination column"),
                F.when(odd_quotes(text), "header spans lines"),
                F.when(~F.col("paired"), "unpaired quotes"),
            )
        ).alias("reasons"),
    )
    reason = F.when(F.size("reasons") > 0, F.array_join("reasons", ", "))
    return found.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).drop("reasons")


def refused_files(listed: DataFrame, inspected: DataFrame) -> DataFrame:
    """(file, size, reason): the listed files that are not read."""
    found = listed.join(inspected.where(~F.col("valid")).select("file", "reason"), "file")
    return found.select("file", "size", "reason")


def header_names(header: str) -> list[str]:
    """The names in a header line; one without a name is numbered."""
    names = next(csv.reader([header.lstrip("\ufeff")]), [])
    return distinct_names([name.strip() or f"column_{i}" for i, name in enumerate(names, 1)])


def readable_path(uri: str) -> str:
    """The path behind a file's URI, with glob characters escaped, to be read as it is."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def ingest(spark: SparkSession, path: str, extracted_at: datetime, malformed: bool = False) -> DataFrame:
    """All admitted files as one table with canonical columns."""
    files = stored(inspect_files(spark, path).filter("valid"), "files")
    return read_files(spark, files, extracted_at, malformed)


def read_files(spark: SparkSession, files: DataFrame, extracted_at: datetime, malformed: bool = False) -> DataFrame:
    """The inspected files as one table.

    Files with the same header, encoding and layout are read together; a single
    read over files with different headers would mix up their columns. The files
    have been looked at once, and the driver sees their paths only, as for any read.
    """
    kinds = files.select("header", "encoding", "multi_line").distinct().collect()
    if not kinds:
        raise ValueError("no file has both a FOB and a destination column")
    parts = []
    for header, encoding, multi_line in sorted(kinds):
        alike = files.filter(
            (F.col("header") == header)
            & (F.col("encoding") == encoding)
            & (F.col("multi_line") == multi_line)
        )
        paths = [readable_path(row.file) for row in alike.select("file").toLocalIterator()]
        names = header_names(header)
        part = read_csv(spark, paths, names, encoding, multi_line, malformed, source=True)
        # Files may carry their own provenance; the names read here take its place.
        own = [
            C.named(old).alias(new)
            for old, new in zip(names, canonical_names(names))
            if new not in (*SOURCE, *PROVENANCE_COLUMNS)
        ]
        # Spark refuses to read the column of malformed records without any other.
        record = F.concat(MALFORMED, F.substring(F.coalesce(C.named(names[0]), F.lit("")), 1, 0))
        bad = [_malformed(record, len(names)).alias(MALFORMED)] if malformed else []
        parts.append(part.select(*own, *SOURCE, *bad, F.lit(extracted_at).alias("EXTRACTION_DATE")))
    return combine(parts)


def _malformed(record: Column, expected: int) -> Column:
    """Fields are counted outside quotes."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    fields = F.size(F.split(bare, ",")).alias("fields")
    return F.when(record.isNotNull(), F.struct(record.alias("record"), fields, F.lit(expected).alias("expected")))


def malformed_rows(raw: DataFrame) -> DataFrame:
    """(file, surplus, short): records with more and with fewer fields than their
    header, for each file that has some."""
    apart = F.col(f"{MALFORMED}.fields") - F.col(f"{MALFORMED}.expected")
    return raw.where(F.col(MALFORMED).isNotNull()).groupBy(F.col("SOURCE_PATH").alias("file")).agg(
        F.count(F.when(apart > 0, 1)).alias("surplus"), F.count(F.when(apart < 0, 1)).alias("short")
    )


def with_provenance(df: DataFrame, extracted_at: datetime) -> DataFrame:
    """S6."""
    return df.withColumns(
        {"SOURCE_FILE": F.col("_metadata.file_name"), "EXTRACTION_DATE": F.lit(extracted_at)}
    )


def combine(parts: list[DataFrame]) -> DataFrame:
    """By column name, with nulls where a part lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
