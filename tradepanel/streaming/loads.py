"""The export job over a folder as a stream of files: every batch is a load.

The stream sees file names only. A batch takes its files through the same steps as a run
of the job, so encodings, headers and layouts may differ from file to file, and the
number of the batch is the name of the load: a batch that is repeated after a failure
replaces what it has written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.exports import load_files
from ..sources.export_files import CSV_FILES

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def batch_load(batch: int) -> str:
    return f"batch{batch:012}"


def load_available(
    spark: SparkSession, landing: str, warehouse: str, checkpoint: str, run_at: datetime, files_per_batch: int = 1000
) -> StreamingQuery:
    """Load all files that are there and stop; the checkpoint remembers them, so that the
    next run meets only newer ones."""
    names = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("pathGlobFilter", CSV_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )

    def load(files: DataFrame, batch: int) -> None:
        load_files(files.sparkSession, files, warehouse, batch_load(batch), run_at)

    return names.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
