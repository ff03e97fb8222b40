"""Low-stock alerts: raised when a product falls below the threshold, re-armed above it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.domain import LOW_STOCK
from tidemark.functions.columns import event_time
from tidemark.functions.envelope import images
from tidemark.operators.scans import landed, previous

STOCK_IMAGE = "product_id:string, stock_qty:string"


def stock_readings(inventory_log: DataFrame) -> DataFrame:
    """Stock levels in log order; deletes and incomplete changes are no readings."""
    after = F.col("after")
    return (
        images(inventory_log, STOCK_IMAGE)
        .select(
            after["product_id"].try_cast("bigint").alias("product_id"),
            after["stock_qty"].try_cast("int").alias("stock_qty"),
            "ts_ms",
            "kafka_offset",
        )
        .where("product_id is not null and stock_qty is not null")
    )


def alert_rows(low_readings: DataFrame, threshold: int) -> DataFrame:
    return low_readings.select(
        "product_id",
        "stock_qty",
        F.lit(threshold).alias("threshold"),
        event_time(F.col("ts_ms")).alias("alert_time"),
    )


def falls(readings: DataFrame, threshold: int) -> DataFrame:
    """Readings that are low while the one before was not. ``readings`` is read twice."""
    low = readings.withColumn("is_low", F.col("stock_qty") < threshold)
    edges = previous(low, "product_id", ["kafka_offset"], "is_low", "low_before")
    return edges.where(F.col("is_low") & ~F.coalesce("low_before", F.lit(False)))


def stock_alerts(readings: DataFrame, threshold: int = LOW_STOCK) -> DataFrame:
    """One alert per fall below the threshold; a product re-arms when it is back above."""
    return alert_rows(falls(landed(readings), threshold), threshold)
