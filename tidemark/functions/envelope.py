"""Change envelopes: JSON text in, typed change rows out. Same code in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.domain import OPS

#: Partition column of bronze tables.
MONTH = "commit_month"

# The images stay JSON text, so a column the source adds later is still captured.
_ENVELOPE = (
    "payload struct<op:string, before:string, after:string, ts_ms:string, "
    "source:struct<lsn:string, ts_ms:string>>, _bad string"
)


def _open(log: DataFrame, shape: str) -> DataFrame:
    """The log with the parsed parts of ``value`` as columns; unreadable text yields nulls.

    Parsing sits in a generator, which filters are not moved below: a filter on a parsed
    field would otherwise be rewritten to parse the text a second time.
    """
    parsed = F.from_json("value", shape, {"columnNameOfCorruptRecord": "_bad"})
    return log.select("*", F.inline(F.array(parsed)))


def decode(log: DataFrame) -> DataFrame:
    """Log records with the envelope parsed once."""
    payload = F.col("payload")
    return _open(log, _ENVELOPE).select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "timestamp",
        "value",
        payload["op"].alias("op"),
        payload["source"]["lsn"].try_cast("bigint").alias("lsn"),
        payload["source"]["ts_ms"].try_cast("bigint").alias("ts_ms"),
        payload["ts_ms"].try_cast("bigint").alias("sent_ms"),
        payload["before"].alias("before"),
        payload["after"].alias("after"),
        payload.isNotNull().alias("has_payload"),
        F.col("_bad").alias("unreadable"),
    )


def known_op(op: Column) -> Column:
    return op.isin(*OPS)


def image_key(key: str) -> Column:
    """The row's key from the after image, or the before image of a delete, over rows of :func:`decode`.

    A new image that came as an object is written compactly by the envelope's parser. Where it begins
    with the key as a plain number, as rows of most tables do, it is not parsed again for it.
    """
    path = f"$.{key}"
    leading = F.regexp_extract("after", f'^\\{{"{key}":([0-9]{{1,18}})[,}}]', 1).try_cast("bigint")
    parsed = F.coalesce(F.get_json_object("after", path), F.get_json_object("before", path)).try_cast("bigint")
    return F.coalesce(F.when(F.col("value").contains('"after":{'), leading), parsed)


def envelope(log: DataFrame, key: str) -> DataFrame:
    """Bronze rows of one topic: log position, operation, key and the whole image."""
    return (
        decode(log)
        .where(known_op(F.col("op")))
        .select(
            "op",
            "lsn",
            "ts_ms",
            "kafka_offset",
            "kafka_partition",
            image_key(key).alias(key),
            F.coalesce("after", "before").alias("raw_payload"),
        )
    )


def with_month(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the month of their commit, which bronze is partitioned by."""
    return bronze.withColumn(MONTH, F.to_date(F.date_trunc("month", F.timestamp_millis("ts_ms"))))


def between(bronze: DataFrame, first_ms: int | None = None, last_ms: int | None = None) -> DataFrame:
    """Changes committed from one time to another, both included. Other months are not read."""
    for limit, keep in ((first_ms, lambda c, x: c >= x), (last_ms, lambda c, x: c <= x)):
        if limit is not None:
            bronze = bronze.where(keep(F.col("ts_ms"), F.lit(limit)))
            if MONTH in bronze.columns:
                month = F.to_date(F.date_trunc("month", F.timestamp_millis(F.lit(limit))))
                bronze = bronze.where(keep(F.col(MONTH), month))
    return bronze


def quarantine(log: DataFrame, key: str) -> DataFrame:
    """Log records that cannot serve, each with the first reason that applies.

    All but those without a key or a commit time are kept out of bronze; those are landed
    too, where the not-null check on the bronze key reports the keyless ones.
    """
    reason = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("unreadable").isNotNull(), "bad json")
        .when(~F.col("has_payload"), "no payload")
        .when(F.col("op").isNull(), "no op")
        .when(~known_op(F.col("op")), "unknown op")
        .when(image_key(key).isNull(), "no key")
        .when(F.col("ts_ms").isNull(), "no time")
    )
    return (
        decode(log)
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("topic", "kafka_partition", "kafka_offset", "timestamp", "reason", "value")
    )


def incomplete(log: DataFrame, *fields: str, ops: tuple[str, ...] = OPS) -> DataFrame:
    """Records of the given operations whose new image lacks a field that a consumer of the
    topic needs, or that have no time at all: what a projection of those fields leaves out."""
    missing = [F.get_json_object("after", f"$.{field}").isNull() for field in fields]
    reason = F.when(F.coalesce("ts_ms", "sent_ms").isNull(), "no time")
    for field, absent in zip(fields, missing, strict=True):
        reason = reason.when(absent, f"no {field}")
    return (
        decode(log)
        .where(F.col("op").isin(*ops))
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("topic", "kafka_partition", "kafka_offset", "timestamp", "reason", "value")
    )


def extract(events: DataFrame, fields: dict[str, tuple[str, str]], source: str = "raw_payload") -> DataFrame:
    """Add typed columns read from a JSON column; what does not parse becomes null.

    Top-level paths share one parse of the text (in a generator, see ``_open``), nested
    paths are read one by one.
    """
    top = {c: path[2:] for c, (path, _) in fields.items() if path[2:].isidentifier()}
    parsed = events
    if top:
        shape = ", ".join(f"`{name}` string" for name in sorted(set(top.values())))
        parsed = events.select("*", F.explode(F.array(F.from_json(source, shape))).alias("_p"))
    typed = [
        (F.col("_p")[top[c]] if c in top else F.get_json_object(source, path)).try_cast(kind).alias(c)
        for c, (path, kind) in fields.items()
    ]
    kept = [c for c in events.columns if c not in fields]
    return parsed.select(*kept, *typed)


def images(log: DataFrame, fields: str) -> DataFrame:
    """Change rows with both images typed in the same single parse of the envelope.

    For consumers of known columns only; text that does not fit becomes null.
    """
    shape = (
        f"payload struct<op:string, before:struct<{fields}>, after:struct<{fields}>, "
        "ts_ms:string, source:struct<lsn:string, ts_ms:string>>"
    )
    payload = F.col("payload")
    return (
        _open(log, shape)
        .where(payload.isNotNull())
        .select(
            "topic",
            "key",
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            payload["op"].alias("op"),
            payload["source"]["lsn"].try_cast("bigint").alias("lsn"),
            F.coalesce(
                payload["source"]["ts_ms"].try_cast("bigint"), payload["ts_ms"].try_cast("bigint")
            ).alias("ts_ms"),
            payload["before"].alias("before"),
            payload["after"].alias("after"),
        )
    )


def commit_times(log: DataFrame) -> DataFrame:
    """Topic, operation and commit time of every change, the rest left unread."""
    payload = F.col("payload")
    return _open(log, "payload struct<op:string, ts_ms:string, source:struct<ts_ms:string>>").select(
        "topic",
        payload["op"].alias("op"),
        F.coalesce(
            payload["source"]["ts_ms"].try_cast("bigint"), payload["ts_ms"].try_cast("bigint")
        ).alias("ts_ms"),
    )


def drop_redelivered(changes: DataFrame) -> DataFrame:
    """One row per change, from rows of :func:`images`.

    A connector that reads its source again sends a change at a new offset and with a new
    send time; its row key, place in the source, commit time, operation and images stay.
    Those are compared, as typed columns, so no JSON text is shuffled, and copies are
    collapsed in the map tasks. The earliest offset is kept, with its partition.
    """
    place = ("kafka_offset", "kafka_partition")
    same = [name for name in changes.columns if name not in place]
    earliest = F.min(F.struct(*place)).alias("place")
    return changes.groupBy(*same).agg(earliest).select(*same, "place.*").select(*changes.columns)
