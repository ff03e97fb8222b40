"""Running values along a key's history, for keys of any size.

A plain window puts a whole key into one task. Here each key's history is cut into
segments by an order-preserving expression (a range of log positions), the window runs
inside the segments, and one summary row per segment carries the value across them. The
summaries of a key are cut in the same way, into groups of segments with one summary each,
so that a task holds a segment, a group of summaries or the groups of a key. With positions
that count bytes, a segment is a megabyte of log and a group of segments a terabyte.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import scratch, tidy


def landed(df: DataFrame) -> DataFrame:
    """``df`` as a table: both the rows and the summaries of their segments are read from it,
    so what stands below, a log and its parsing, is read once."""
    path = scratch(df.sparkSession, "scan")
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A segment spans 2**20 log positions, which bounds the rows of one window group.
SEGMENT_BITS = 20


def segment_of(position: str, bits: int = SEGMENT_BITS) -> Column:
    return F.shiftright(F.coalesce(F.col(position), F.lit(0)).cast("bigint"), bits)


class _Fold(NamedTuple):
    """How ``_total`` of earlier rows becomes one value: over a window, over a group of which
    ``order`` is the order, and of what is nearer with what lies before it."""

    over: Callable[[WindowSpec], Column]
    group: Callable[[str], Column]
    both: Callable[[Column, Column], Column]


_SUM = _Fold(
    lambda window: F.sum("_total").over(window),
    lambda order: F.sum("_total"),
    lambda near, far: F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0)),
)
_LAST = _Fold(
    lambda window: F.last("_total", ignorenulls=True).over(window),
    lambda order: F.max_by("_total", F.when(F.col("_total").isNotNull(), F.col(order))),
    F.coalesce,
)


def _with_carry(df: DataFrame, key: str, totals: DataFrame, fold: _Fold, bits: int) -> DataFrame:
    """Join each segment with ``_carry``: ``fold`` of the totals of the key's earlier segments."""
    grouped = totals.withColumn("_group", F.shiftright("_segment", bits))
    near = grouped.select(key, "_segment", "_group", fold.over(_earlier("_segment", key, "_group")).alias("_near"))
    groups = grouped.groupBy(key, "_group").agg(fold.group("_segment").alias("_total"))
    far = groups.select(key, "_group", fold.over(_earlier("_group", key)).alias("_far"))
    carry = fold.both(F.col("_near"), F.col("_far")).alias("_carry")
    earlier = near.join(far, [key, "_group"], "left").select(key, "_segment", carry)
    return df.join(earlier, [key, "_segment"], "left")


def _earlier(order: str, *keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, bits: int = SEGMENT_BITS
) -> DataFrame:
    """Sum of ``value`` over the key's rows up to and including this one."""
    cut = df.withColumn("_segment", segment_of(order[0], bits))
    inside = Window.partitionBy(key, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_local", F.sum(value).over(inside))
    totals = cut.groupBy(key, "_segment").agg(F.sum(value).alias("_total"))
    joined = _with_carry(local, key, totals, _SUM, bits)
    total = F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return joined.withColumn(name, total).drop("_segment", "_local", "_carry")


def previous(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, bits: int = SEGMENT_BITS
) -> DataFrame:
    """``value`` of the key's preceding row, null on its first row."""
    cut = df.withColumn("_segment", segment_of(order[0], bits))
    inside = Window.partitionBy(key, "_segment").orderBy(*order)
    # Wrapped in a struct, so that a preceding null differs from no preceding row.
    local = cut.withColumn("_local", F.lag(F.struct(value)).over(inside))
    # By a single column this aggregates in a hash table, without sorting.
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    totals = cut.groupBy(key, "_segment").agg(F.struct(F.max_by(value, position).alias(value)).alias("_total"))
    joined = _with_carry(local, key, totals, _LAST, bits)
    return joined.withColumn(name, F.coalesce("_local", "_carry")[value]).drop("_segment", "_local", "_carry")


def carry_forward(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, bits: int = SEGMENT_BITS
) -> DataFrame:
    """The last known ``value`` of the key at or before this row."""
    cut = df.withColumn("_segment", segment_of(order[0], bits))
    inside = Window.partitionBy(key, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    position = F.when(F.col(value).isNotNull(), F.struct(*order))
    totals = cut.groupBy(key, "_segment").agg(F.max_by(value, position).alias("_total"))
    joined = _with_carry(local, key, totals, _LAST, bits)
    return joined.withColumn(name, F.coalesce("_local", "_carry")).drop("_segment", "_local", "_carry")
