"""The export cleaning as a stream over a folder: each new file is read once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.exports import canonicalise, clean_exports
from ..schemas import all_text
from ..sources.export_files import with_provenance


def read_stream(
    spark: SparkSession, path: str, columns, extracted_at: datetime, files_per_batch: int = 1000
) -> DataFrame:
    """New CSV files of one layout as they arrive, as text columns."""
    lines = (
        spark.readStream.schema(all_text(columns))
        .option("header", "true")
        .option("escape", '"')
        .option("multiLine", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    return canonicalise(with_provenance(lines, extracted_at))


def clean_available(lines: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Clean all files that are there and stop; the checkpoint remembers them, so
    that the next run reads only newer ones. No state is kept between rows."""
    return (
        clean_exports(lines)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("YEAR")
        .trigger(availableNow=True)
        .start(table)
    )
