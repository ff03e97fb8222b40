"""Reading and writing the change log, as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.domain import LOG_SCHEMA
from tidemark.session import tidy


def write_log(log: DataFrame, path: str, ranged: bool = False) -> None:
    """Append records to a file log: a sub-folder per topic and log partition, whose records
    lie in files by ranges of offsets. ``ranged``: the records come in such ranges already."""
    if not ranged:
        place = ("topic", "partition", "offset")
        log = log.repartitionByRange(*place).sortWithinPartitions(*place)
    with tidy(log.sparkSession):
        log.write.mode("append").option("compression", "zstd").partitionBy("topic", "partition").parquet(path)


def read_log(
    spark: SparkSession,
    path: str | None = None,
    topics: Iterable[str] = (),
    *,
    fmt: str = "parquet",
    streaming: bool = False,
    start: str = "earliest",
    since_ms: int | None = None,
    **options: str,
) -> DataFrame:
    """The log's records: topic, partition, offset, timestamp, key, value.

    ``fmt="kafka"`` reads brokers (pass ``kafka.bootstrap.servers`` among the options,
    and have the connector on the class path); any file format reads a log folder
    written by ``write_log``. A batch read covers the log up to its current end. A
    stream starts at the earliest record, or with ``start="latest"`` skips what is
    older than ``since_ms`` (files) or the current end (Kafka).
    """
    topics = list(topics)
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        source = reader.format("kafka").options(**options).option("subscribe", ",".join(topics))
        if streaming or start == "earliest":
            source = source.option("startingOffsets", start)
        return source.load().select(
            "topic",
            "partition",
            "offset",
            "timestamp",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
    log = reader.schema(LOG_SCHEMA).options(**options).format(fmt).load(path)
    if topics:
        log = log.where(F.col("topic").isin(*topics))
    if start == "latest":
        if since_ms is None:
            raise ValueError("a file log has no end mark: start='latest' needs since_ms")
        log = log.where(F.unix_millis("timestamp") >= since_ms)
    return log.select("topic", "partition", "offset", "timestamp", "key", "value")
