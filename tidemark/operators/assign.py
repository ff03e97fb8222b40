"""Weighted assignment: give each row a name, in proportion to the names' weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch


def bands(weights: DataFrame, name: str, weight: str) -> DataFrame:
    """Half-open ``[lo, hi)`` bands in cumulative weight, heaviest first, for lists of any length.

    The list is range sorted; sums run inside each sorted partition and start from the total
    of the partitions before it. Only those totals, one per partition, meet in one task.
    """
    spark, path = weights.sparkSession, scratch(weights.sparkSession, "weights")
    order = [F.col(weight).desc(), F.col(name)]
    listed = weights.select(name, F.col(weight).cast("bigint").alias(weight)).where(F.col(weight) > 0)
    ranged = listed.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    # monotonically_increasing_id: partition number above bit 33, row number below.
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    upper = F.col("_start") + F.sum(weight).over(Window.partitionBy("_part").orderBy("_place"))
    return placed.join(starts, "_part").select(name, (upper - F.col(weight)).alias("lo"), upper.alias("hi"))


def weighted_assignment(rows: DataFrame, weights: DataFrame, name: str, weight: str, point: Column) -> DataFrame:
    """Attach the name whose band holds ``point mod total weight``.

    The range condition becomes an equality on a cell: the range is cut into as many cells
    as there are bands, each band is listed under the cells it overlaps (twice as many rows
    as bands at most), and rows look only into their own cell. Bands are disjoint, so at most
    one matches. One plan for all lengths: Spark broadcasts a list it measures as small; a
    cell that very many rows fall into is split by the adaptive skew join.
    """
    known = bands(weights, name, weight)
    scale = known.agg(
        F.max("hi").alias("total"), F.greatest(F.ceil(F.max("hi") / F.count("*")), F.lit(1)).cast("bigint").alias("width")
    )
    width = scale.select("width").scalar()
    cell = lambda c: F.floor(c / width).cast("bigint")
    covered = known.select(name, "lo", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("_cell"))
    picked = rows.withColumn("_pick", F.pmod(point, scale.select("total").scalar()))
    picked = picked.withColumn("_picked_cell", cell(F.col("_pick")))
    hit = (F.col("_picked_cell") == F.col("_cell")) & (F.col("_pick") >= F.col("lo")) & (F.col("_pick") < F.col("hi"))
    return picked.join(covered, hit, "left").select(*rows.columns, name)
