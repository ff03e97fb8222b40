"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_FOLDERS: dict[str, str] = {}

#: Shuffle partitions that adaptive execution starts from and merges to fair sizes. One high
#: number for all inputs; a session may be built with another.
SHUFFLE_PARTITIONS = "2000"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Bytes of a file that one task reads: change records take up ten times as much in memory.
READ_BYTES = "32m"


#: Whether a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Settings results depend on: calendar days are UTC days. Unless the session says otherwise,
    a task reads less than Spark's 128 MB, as it sorts what it reads."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.files.maxPartitionBytes", None) is None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", READ_BYTES)
    return spark


def build_session(app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": SHUFFLE_PARTITIONS,
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Tables written in here leave no shuffle files: else those of every step lie on the disks until the
    driver's garbage collector happens to come by."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def work_dir(spark: SparkSession) -> str:
    """A folder of this application's own that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A session on one machine, in local mode, may go
    without that setting and gets a temporary folder; any other must name a shared one, as
    a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not shared:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="tidemark-")
        _FOLDERS[app] = f"{shared.rstrip('/')}/tidemark-{app}-{uuid.uuid4().hex[:8]}"
    return _FOLDERS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the work folder, never used before."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
