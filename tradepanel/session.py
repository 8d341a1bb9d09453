"""Session settings and the shared workspace folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from .sources import folders

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Whether the shuffle files of a query go when it ends. By itself Spark drops them when the
#: driver's garbage collection meets their plan, which may not be before the session ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tradepanel") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Small inputs on one machine are bound by the processor, not by reads: keep
        # one task per core where Spark would merge them into few, or, by a
        # broadcast, leave all lines in the one task that has read them.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """The folder for written intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder, since every task runs there.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tradepanel-")
        context.setCheckpointDir(_local_folders[context.applicationId])
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the workspace; nothing is ever overwritten by accident."""
    folder = f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
    if (named := _scratch.get()) is not None:
        named.append(folder)
    return folder


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """For the steps of a job that leave nothing in the workspace: the folders that
    ``new_folder`` names within it are removed in the end, and the shuffle files of each
    query when it ends. What is read later must be written elsewhere."""
    before, named = spark.conf.get(SHUFFLE_CLEANUP, None), []
    token = _scratch.set(named)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        _scratch.reset(token)
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
        for folder in named:
            folders.remove(spark, folder)
