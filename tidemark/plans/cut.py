"""One consistent cut over all entities at a commit time that every log has reached.

Topics are landed by queries of their own, so at any moment one is ahead of the other. A log
is known up to the least of its partitions' newest commit times; the tables agree up to the
least of these. A topic that has been quiet holds the cut back until its next record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.state import state_as_of


def reached(bronze: dict[str, DataFrame]) -> DataFrame:
    """(table_name, reached_ms): how far each entity's log is known, null for one without rows."""
    tables = [
        table.groupBy("kafka_partition")
        .agg(F.max("ts_ms").alias("newest_ms"))
        .agg(F.min("newest_ms").alias("reached_ms"))
        .select(F.lit(name).alias("table_name"), "reached_ms")
        for name, table in bronze.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def cut_time(bronze: dict[str, DataFrame], wanted_ms: int | None = None) -> int | None:
    """The greatest commit time that all logs have reached, or the one wanted if that is earlier.

    Null if a log has no rows. The number comes to the driver, so that the cut prunes months.
    """
    least = reached(bronze).agg(F.min("reached_ms"), F.count_if(F.col("reached_ms").isNull())).first()
    if least[1] or least[0] is None:
        return None
    return least[0] if wanted_ms is None else min(least[0], wanted_ms)


def consistent_cut(bronze: dict[str, DataFrame], wanted_ms: int | None = None) -> dict[str, DataFrame]:
    """Staging of every entity at one commit time (see :func:`cut_time`).

    Lines whose order has not been committed by then have ``is_waiting`` set: they are in the
    log, but not yet part of an order; the others have their order in the cut. Without a
    common time all tables are empty.
    """
    cut = cut_time(bronze, wanted_ms)
    if cut is None:
        bronze, cut = {name: table.limit(0) for name, table in bronze.items()}, 0
    tables = {name: state_as_of(table, name, cut) for name, table in bronze.items()}
    known = tables["orders"].select("order_id", F.lit(False).alias("is_waiting"))
    lines = tables["order_items"].join(known, "order_id", "left")
    columns = tables["order_items"].columns
    tables["order_items"] = lines.select(*columns, F.coalesce("is_waiting", F.lit(True)).alias("is_waiting"))
    return tables


def cut_counts(bronze: dict[str, DataFrame], wanted_ms: int | None = None) -> DataFrame:
    """(table_name, n, deleted, waiting) of each table of the cut."""
    counts = []
    for name, table in consistent_cut(bronze, wanted_ms).items():
        waiting = F.count_if("is_waiting") if "is_waiting" in table.columns else F.lit(0).cast("bigint")
        row = table.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_deleted").alias("deleted"), waiting.alias("waiting"))
        counts.append(row.select(F.lit(name).alias("table_name"), "n", "deleted", "waiting"))
    return reduce(DataFrame.unionByName, counts)
