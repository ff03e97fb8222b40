"""Low-stock alerts on a stream, with one remembered reading per product."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.domain import LOW_STOCK
from tidemark.functions.columns import event_time
from tidemark.plans.alerts import stock_readings
from tidemark.session import ROCKSDB
from tidemark.streaming.jobs import INTERVAL
from tidemark.streaming.sinks import append_batch, read_appended, run_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Products are dealt to so many groups, each with one state value that holds a reading per product: a state
#: value costs a round trip to the state store, and a batch has readings of very many products.
BUCKETS = 256
#: Tasks that hold the state of those groups. Each opens and commits a store of its own in every batch, so
#: that with a session's many shuffle partitions a batch of few readings would cost mostly that.
STATE_TASKS = 16
MEMORY_SCHEMA = "products binary, low binary, offsets binary"
FOUND_SCHEMA = "product_id bigint, stock_qty int, ts_ms bigint, kafka_offset bigint, late boolean"


class FallDetector(StatefulProcessor):
    """Readings of a product that are low while the one before was not.

    The state has for each product of a group whether its last reading was low, and its offset.
    Readings of a batch are put in order before they are looked at. One that arrives after a later
    one of its product comes out marked as late and changes nothing: over a log read by offset
    there is none. A group's readings of one batch, no more than the batch has, are in memory.
    """

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", MEMORY_SCHEMA)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        columns = {name: [] for name in ("product_id", "stock_qty", "ts_ms", "kafka_offset")}
        for part in rows:
            for name, parts in columns.items():
                parts.append(part[name].to_numpy())
        product, stock, ts_ms, offset = (np.concatenate(parts) for parts in columns.values())
        order = np.lexsort((offset, product))
        product, stock, ts_ms, offset = (values[order] for values in (product, stock, ts_ms, offset))

        kept = self.memory.get()
        known, was_low, last = (
            np.frombuffer(bytes(kept[i]) if kept else b"", kind) for i, kind in enumerate((np.int64, np.bool_, np.int64))
        )
        at = np.minimum(np.searchsorted(known, product), max(len(known) - 1, 0))
        seen = known[at] == product if len(known) else np.zeros(len(product), bool)
        late = seen & (offset <= last[at]) if len(known) else seen
        before = seen & was_low[at] if len(known) else seen

        low = stock < self.threshold
        on = np.flatnonzero(~late)
        first = np.ones(len(on), bool)
        first[1:] = product[on][1:] != product[on][:-1]
        earlier = np.empty(len(on), bool)
        earlier[1:] = low[on][:-1]
        fallen = on[low[on] & ~np.where(first, before[on], earlier)]

        newest = on[np.append(first[1:], True)] if len(on) else on
        stays = ~np.isin(known, product[newest])
        merged = [np.concatenate([a[stays], b[newest]]) for a, b in ((known, product), (was_low, low), (last, offset))]
        ranked = np.argsort(merged[0])
        self.memory.update(tuple(values[ranked].tobytes() for values in merged))

        out = np.concatenate([fallen, np.flatnonzero(late)])
        if len(out):
            yield pd.DataFrame(
                {"product_id": product[out], "stock_qty": stock[out], "ts_ms": ts_ms[out], "kafka_offset": offset[out], "late": late[out]}
            )

    def close(self) -> None:
        pass


def raise_alerts(
    inventory_log: DataFrame, root: str, every: str | None = INTERVAL, threshold: int = LOW_STOCK
) -> StreamingQuery:
    """Append alerts to the ops table, batch by batch: one pass over a batch, one write.

    The order of a product's readings decides, so the log is to be read by offset
    (:func:`tidemark.sources.offsets.stream_log`), with this job's :func:`checkpoint`. A batch that
    fails is repeated from the state before it, so no alert is lost or doubled.
    """
    spark = inventory_log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    found = (
        stock_readings(inventory_log)
        .select("*", bucket)
        .groupBy("bucket")
        .transformWithStateInPandas(FallDetector(threshold), FOUND_SCHEMA, outputMode="Append", timeMode="None")
    )
    marked = found.withColumn("threshold", F.lit(threshold))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(STATE_TASKS, int(partitions)))  # a query keeps what it starts with
    try:
        return run_stream(marked, append_batch(f"{root}/ops/stock_alerts"), checkpoint(root), every=every, name="stock-alerts")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def checkpoint(root: str) -> str:
    return f"{root}/checkpoints/stock_alerts"


def _read(spark: SparkSession, root: str, late: bool) -> DataFrame:
    found = read_appended(spark, f"{root}/ops/stock_alerts", f"{FOUND_SCHEMA}, threshold int")
    return found.where(F.col("late") == late)


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    found = _read(spark, root, late=False)
    return found.select("product_id", "stock_qty", "threshold", event_time(F.col("ts_ms")).alias("alert_time"))


def late_readings(spark: SparkSession, root: str) -> DataFrame:
    """Readings that arrived after a later one of their product, with their offsets."""
    return _read(spark, root, late=True).select("product_id", "stock_qty", "ts_ms", "kafka_offset")

