"""Latest (or past) state of each entity out of its change history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.domain import FIELDS, KEYS
from tidemark.functions.envelope import MONTH, between, extract, known_op

LOG_ORDER = ("lsn", "ts_ms", "kafka_offset")


#: On rows of a merge: 1 where the row came with it, -1 where it went, null where it stayed.
MARK = "_mark"


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_by_key(events: DataFrame, keys: Sequence[str], order: Sequence[str] = LOG_ORDER) -> DataFrame:
    """The last version of each key in log order; unknown positions rank last.

    Written as ``row_number() = 1``, which Spark runs as a group limit on both sides of
    the shuffle: each map task sends one row per key, however many versions it holds.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    return (
        events.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def soft_delete(state: DataFrame) -> DataFrame:
    return state.withColumn("is_deleted", F.coalesce(F.col("op") == "d", F.lit(False)))


def active(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_deleted"))


def latest_rows(bronze: DataFrame, entity: str) -> DataFrame:
    """Latest bronze row of every key, its payload unread."""
    known = bronze.where(known_op(F.col("op"))).drop("kafka_partition", MONTH)
    return latest_by_key(known, [KEYS[entity]])


def entity_state(bronze: DataFrame, entity: str, *fields: str) -> DataFrame:
    """Latest version of every row of one entity, with its log position.

    The payload is read after the ranking: a row's older versions are never parsed, and
    most do not leave their map task. ``fields`` limits what is read of it.
    """
    wanted = {name: FIELDS[entity][name] for name in fields or FIELDS[entity]}
    return extract(latest_rows(bronze, entity), wanted).drop("raw_payload")


def staged(state: DataFrame, entity: str, *fields: str) -> DataFrame:
    return soft_delete(state).select(KEYS[entity], *(fields or FIELDS[entity]), "is_deleted")


def stage(bronze: DataFrame, entity: str, *fields: str) -> DataFrame:
    """The staging view of one entity: one row per key, deletes flagged."""
    return staged(entity_state(bronze, entity, *fields), entity, *fields)


def stage_of(bronze: DataFrame, entity: str, few: DataFrame, *fields: str) -> DataFrame:
    """The staging view of the few rows whose keys ``few`` holds, a result of ``limit k``.

    All versions of a key are kept or none, so the ranking sees whole histories; rows of
    other keys go before it. A semi join may broadcast its small side, a right join not.
    """
    key = KEYS[entity]
    kept = bronze.join(F.broadcast(few.select(key).where(F.col(key).isNotNull()).distinct()), key, "left_semi")
    return stage(kept, entity, *fields)


def state_as_of(bronze: DataFrame, entity: str, cutoff_ms: int) -> DataFrame:
    """The staging view as it stood at a commit time: cut first, then rank."""
    return stage(between(bronze, last_ms=cutoff_ms), entity)


def upsert(state: DataFrame, changes: DataFrame, entity: str) -> DataFrame:
    """New full state from the current one and later bronze rows, which may overlap it.

    Only log positions decide, so replayed or late changes do no harm.
    """
    key = KEYS[entity]
    return latest_by_key(state.unionByName(entity_state(changes, entity)), [key])


def both_states(state: DataFrame, latest: DataFrame) -> DataFrame:
    """A state and the later one of some of its keys, stacked for :func:`merged`."""
    return state.withColumn("_new", F.lit(False)).unionByName(latest.withColumn("_new", F.lit(True)))


def merged(both: DataFrame, entity: str, shard: Sequence[str]) -> DataFrame:
    """:func:`upsert` of a state with the latest rows of changed keys, each with one row per key, that also
    keeps the rows which are replaced: every row has its :data:`MARK`.

    Rows are shuffled once, by ``shard``, columns that follow from the key and have a bounded number of keys
    each. Of a row and its replay at the same log position, the one of the state stays.
    """
    versions = Window.partitionBy(*shard, KEYS[entity]).orderBy(*_newest_first(LOG_ORDER), "_new")
    ranked = both.repartition(*shard).withColumn("_rank", F.row_number().over(versions))
    newest, new = F.col("_rank") == 1, F.col("_new")
    mark = F.when(newest & new, F.lit(1)).when(~newest, F.lit(-1)).cast("tinyint")
    return ranked.where(newest | ~new).withColumn(MARK, mark).drop("_rank", "_new")
