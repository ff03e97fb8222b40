"""A change log for the given tables: what a connector would have sent for them.

The tables hold final rows only, so their history is derived by key arithmetic alone;
FIXTURES.md states the rules. The records are real JSON envelopes in log layout
(topic, partition, offset, timestamp, key, value).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.domain import INVENTORY
from tidemark.operators.scans import landed, running_sum
from tidemark.session import scratch, tidy
from tidemark.sources.tables import epoch_ms, read_table

# Lifecycle paths by order key modulo 100, as half-open bands.
PATHS = (
    (0, 18, ("CREATED", "CANCELLED")),
    (18, 21, ("CREATED", "PAID")),
    (21, 26, ("CREATED", "PAID", "REFUNDED")),
    (26, 30, ("CREATED", "PAID", "PREPARING", "REFUNDED")),
    (30, 33, ("CREATED", "PAID", "PREPARING", "SHIPPED")),
    (33, 93, ("CREATED", "PAID", "PREPARING", "SHIPPED", "DELIVERED")),
    (93, 100, ("CREATED", "PAID", "PREPARING", "SHIPPED", "DELIVERED", "RETURNED", "REFUNDED")),
)
# Order key modulo 700 -> hops kept, so that every status is also a last one.
CUT_SHORT = ((99, 1), (199, 3), (299, 6))

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
SNAPSHOT_MS = 788_918_400_000  # 1995-01-01T00:00:00Z
SNAPSHOT_LSN = 1
PARTITIONS = 3

#: What the faulty log states.
WRONG_AMOUNT = "-500000000.00"
WRONG_QUANTITY = "-100000"

#: Records of a log file, about: what one task builds, whatever the session's partitions.
FILE_RECORDS = 131_072

_KEEP_NULLS = {"ignoreNullFields": "false"}


def lifecycle(key: str) -> Column:
    """The statuses an order passes through, first to last."""
    band = F.pmod(F.col(key), F.lit(100))
    path = None
    for low, high, hops in PATHS:
        hit = (band >= low) & (band < high)
        array = F.array(*[F.lit(h) for h in hops])
        path = F.when(hit, array) if path is None else path.when(hit, array)
    kept = F.size(path)
    for residue, hops in CUT_SHORT:
        kept = F.when(F.pmod(F.col(key), F.lit(700)) == residue, F.lit(hops)).otherwise(kept)
    return F.slice(path, F.lit(1), kept)


def is_cleaned_up(key: str, path: Column) -> Column:
    """Whether the order, with its lines, is deleted after its last hop."""
    last = F.element_at(path, -1)
    return (F.pmod(F.col(key), F.lit(20)) == 3) & last.isin("CANCELLED", "REFUNDED")


def record(topic: str, key: Column, op: Column, lsn: Column, ts_ms: Column, before: Column, after: Column, offset: Column) -> list[Column]:
    """The log columns of one change."""
    payload = F.struct(
        op.alias("op"),
        before.alias("before"),
        after.alias("after"),
        F.struct(lsn.alias("lsn"), ts_ms.alias("ts_ms")).alias("source"),
        (ts_ms + 250).alias("ts_ms"),
    )
    return [
        F.lit(topic).alias("topic"),
        F.pmod(key, F.lit(PARTITIONS)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.timestamp_millis(ts_ms + 250).alias("timestamp"),
        key.cast("string").alias("key"),
        F.to_json(F.struct(payload.alias("payload")), _KEEP_NULLS).alias("value"),
    ]


def in_ranges(rows: DataFrame, key: str, offset: str, tasks: int) -> DataFrame:
    """``rows`` dealt by log partition and ranges of what their offsets rise with, for the log written from them.

    What is sorted and shuffled are the narrow table rows: their records, some ten times as wide and
    several of them per row, are built afterwards, in tasks of a bounded number of records.
    """
    place = (F.pmod(F.col(key), F.lit(PARTITIONS)), F.col(offset))
    return rows.repartitionByRange(tasks, *place).sortWithinPartitions(*place)


def log_tasks(rows: DataFrame, changes: int = 1) -> int:
    """Tasks for the log of ``rows`` with so many changes each."""
    return max(1, math.ceil(rows.count() * changes / FILE_RECORDS))


def _utc(column: str) -> Column:
    return F.date_format(F.col(column).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def orders_log(spark: SparkSession, folder: str) -> DataFrame:
    """One create per order, one update per further hop, at times a final delete."""
    given = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    orders = in_ranges(given, "o_orderkey", "o_orderkey", log_tasks(given, changes=4)).select(
        "o_orderkey",
        "o_custkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        _utc("o_orderdate").alias("created_at"),
        epoch_ms("o_orderdate").alias("created_ms"),
        "o_orderpriority",
        lifecycle("o_orderkey").alias("path"),
    )
    cleaned = is_cleaned_up("o_orderkey", F.col("path"))
    steps = F.size("path") + F.when(cleaned, 1).otherwise(0)
    hops = orders.withColumn("hop", F.explode(F.sequence(F.lit(0), steps - 1)))

    def image(hop: Column) -> Column:
        # Some orders are repriced on their fourth hop; every other one carries a column
        # that the staging schema does not know.
        repriced = (F.pmod("o_orderkey", F.lit(250)) == 40) & (hop >= 3)
        amount = F.when(repriced, F.col("amount") + 10).otherwise(F.col("amount")).cast("decimal(12,2)")
        return F.struct(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.element_at("path", F.least(hop + 1, F.size("path")).cast("int")).alias("status"),
            amount.cast("string").alias("total_amount"),
            F.col("created_at"),
            F.when(F.pmod("o_orderkey", F.lit(2)) == 1, F.col("o_orderpriority")).alias("priority"),
        )

    hop = F.col("hop")
    gone = hop >= F.size("path")
    lsn = (F.col("o_orderkey") + 1) * 16 + hop
    return hops.select(
        *record(
            "orders",
            F.col("o_orderkey"),
            F.when(gone, "d").when(hop == 0, "c").otherwise("u"),
            lsn,
            F.col("created_ms") + hop * HOUR_MS,
            F.when(hop > 0, image(hop - 1)),
            F.when(~gone, image(hop)),
            lsn,
        )
    )


def users_log(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot row per customer; some later move to the next city, some are deleted."""
    nation = read_table(spark, folder, "nation")
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home"))
    target = nation.select(
        F.pmod(F.col("n_nationkey") - 1, F.lit(25)).alias("c_nationkey"), F.col("n_name").alias("target")
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    users = (
        in_ranges(customers, "c_custkey", "c_custkey", log_tasks(customers))
        .join(home, "c_nationkey", "left")
        .join(target, "c_nationkey", "left")
    )
    key = F.col("c_custkey")
    moves = F.pmod(key, F.lit(10)) == 4
    leaves = F.pmod(key, F.lit(50)) == 9
    ops = F.when(moves, F.array(F.lit("r"), F.lit("u"))).when(leaves, F.array(F.lit("r"), F.lit("d")))
    changes = users.withColumn("op", F.explode(F.coalesce(ops, F.array(F.lit("r")))))

    def image(city: Column) -> Column:
        return F.struct(
            key.alias("user_id"),
            F.col("c_name").alias("full_name"),
            city.alias("city"),
            F.lit("1995-01-01T00:00:00Z").alias("created_at"),
        )

    op = F.col("op")
    snapshot = op == "r"
    home_image, new_image = image(F.col("home")), image(F.col("target"))
    return changes.select(
        *record(
            "users",
            key,
            op,
            F.when(snapshot, F.lit(SNAPSHOT_LSN)).otherwise((key + 1) * 160 + 8),
            F.lit(SNAPSHOT_MS) + F.when(snapshot, 0).otherwise((F.pmod(key, F.lit(2000)) + 1) * DAY_MS),
            F.when(~snapshot, home_image),
            F.when(snapshot, home_image).when(op == "u", new_image),
            key * 2 + F.when(snapshot, 0).otherwise(1),
        )
    )


def products_log(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot row per part; some are repriced later."""
    key = F.col("p_partkey")
    given = read_table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_type", F.col("p_retailprice").cast("decimal(10,2)").alias("price")
    )
    parts = in_ranges(given, "p_partkey", "p_partkey", log_tasks(given))
    ops = F.when(F.pmod(key, F.lit(40)) == 7, F.array(F.lit("r"), F.lit("u"))).otherwise(F.array(F.lit("r")))
    changes = parts.withColumn("op", F.explode(ops))

    def image(price: Column) -> Column:
        return F.struct(
            key.alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            price.cast("decimal(10,2)").cast("string").alias("price"),
        )

    snapshot = F.col("op") == "r"
    old, new = image(F.col("price")), image(F.col("price") + 5)
    return changes.select(
        *record(
            "products",
            key,
            F.col("op"),
            F.when(snapshot, F.lit(SNAPSHOT_LSN)).otherwise((key + 1) * 160 + 9),
            F.lit(SNAPSHOT_MS) + F.when(snapshot, 0).otherwise((F.pmod(key, F.lit(2000)) + 1) * DAY_MS),
            F.when(~snapshot, old),
            F.when(snapshot, old).otherwise(new),
            key * 2 + F.when(snapshot, 0).otherwise(1),
        )
    )


_LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
)


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with ``order_item_id``: their place in the total order of the table.

    Lines have no key of their own. They are range-sorted, so no order however long
    lands in one task, and numbered by partition start plus place in the partition. The
    sorted rows are written first: the range cuts come from a sample, and both the
    partition counts and the numbers must see the same cuts. Equal lines are told apart
    by their place in the input, so that many copies of one line do not pile up either.
    """
    path = scratch(spark, "lines")
    order = (*_LINE_ORDER, "_copy")
    placed = (
        read_table(spark, folder, "lineitem")
        .select(*_LINE_ORDER, F.monotonically_increasing_id().alias("_copy"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_copy")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    with tidy(spark):
        placed.write.option("compression", "zstd").parquet(path)
    # monotonically_increasing_id: partition number above bit 33, row number below.
    lines = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    sizes = lines.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition of the sort, so one task for the starts is enough.
    starts = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"),
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # Joined where they lie: a shuffle by sort partition would move every line once more, into few tasks.
    return lines.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + row + 1).alias("order_item_id"), *_LINE_ORDER
    )


def _line_ms() -> Column:
    """Commit time of a line: its ship day, at a minute of the first hour."""
    return epoch_ms("l_shipdate") + F.pmod("l_orderkey", F.lit(60)) * MINUTE_MS


def order_items_log(lines: DataFrame) -> DataFrame:
    """A create per line, and a delete for the lines of cleaned-up orders."""
    given = lines.select("order_item_id", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    lines = in_ranges(given, "order_item_id", "order_item_id", log_tasks(given)).withColumn("path", lifecycle("l_orderkey"))
    ops = F.when(is_cleaned_up("l_orderkey", F.col("path")), F.array(F.lit("c"), F.lit("d"))).otherwise(F.array(F.lit("c")))
    changes = lines.withColumn("op", F.explode(ops))
    key = F.col("order_item_id")
    image = F.struct(
        key,
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("unit_price"),
    )
    created = F.col("op") == "c"
    place = key * 2 + F.when(created, 0).otherwise(1)
    return changes.select(
        *record(
            "order_items",
            key,
            F.col("op"),
            place,
            _line_ms() + F.when(created, 0).otherwise(MINUTE_MS),
            F.when(~created, image),
            F.when(created, image),
            place,
        )
    )


def inventory_log(lines: DataFrame) -> DataFrame:
    """Stock per part after each line: falls with sales, jumps up on a restock."""
    sales = lines.select(
        "order_item_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _line_ms().alias("ms"),
    )
    sold = running_sum(sales, "product_id", ["order_item_id"], "quantity", "sold")
    # The ranges' cuts come from a sample: landed, so that the sums are worked out once.
    stock = in_ranges(landed(sold), "product_id", "order_item_id", log_tasks(lines))
    key = F.col("product_id")
    after = F.struct(key, (100 - F.pmod("sold", F.lit(100))).cast("int").alias("stock_qty"))
    place = F.col("order_item_id")
    return stock.select(
        *record(
            INVENTORY, key, F.lit("u"), place, F.col("ms"), F.lit(None).cast("string"), after, place
        )
    )


def native_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as change rows: it is a log of its own, keyed by user."""
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type").isin("click", "purchase"), "u")
        .when(F.col("event_type") == "error", "d")
    )
    return read_table(spark, folder, "events").select(
        op.alias("op"),
        F.col("event_id").alias("lsn"),
        epoch_ms("ts").alias("ts_ms"),
        F.col("event_id").alias("kafka_offset"),
        F.lit(0).alias("kafka_partition"),
        "user_id",
        F.col("props").alias("raw_payload"),
        F.col("value").cast("decimal(12,2)").alias("measure"),
    )


def damaged(log: DataFrame) -> DataFrame:
    """The same log as a faulty line would deliver it, to exercise the quarantine."""
    key = F.col("key").cast("bigint")
    residue = F.pmod(key, F.lit(97))
    value = (
        F.when(residue == 5, F.substring("value", 1, 40))
        .when(residue == 6, F.lit(None).cast("string"))
        .when(residue == 7, F.lit('{"payload":null}'))
        .when(residue == 8, F.regexp_replace("value", '"op":"[a-z]"', '"op":"t"'))
        .when(residue == 9, F.regexp_replace("value", '"op":"[a-z]"', '"op":null'))
        .when(residue == 10, F.regexp_replace("value", '"order_id":[0-9]+', '"order_id":null'))
        .otherwise(F.col("value"))
    )
    return log.withColumn("value", value)


def faulty(log: DataFrame) -> DataFrame:
    """The same log from a source that loses and misstates rows, for the data checks to find:
    by key modulo 97, orders that never arrive (13), with statuses nobody knows (11, 12) or
    with negative amounts, and lines with negative quantities (14)."""
    residue = F.pmod(F.col("key").cast("bigint"), F.lit(97))
    orders, lines = F.col("topic") == "orders", F.col("topic") == "order_items"

    def stated(field: str, value: str) -> Column:
        return F.regexp_replace("value", f'"{field}":("[^"]*"|[0-9]+)', f'"{field}":{value}')

    value = (
        F.when(orders & (residue == 11), stated("status", '"LOST"'))
        .when(orders & (residue == 12), stated("status", '"HELD"'))
        .when(orders & (residue == 14), stated("total_amount", f'"{WRONG_AMOUNT}"'))
        .when(lines & (residue == 14), stated("quantity", WRONG_QUANTITY))
        .otherwise(F.col("value"))
    )
    return log.where(~orders | (residue != 13)).withColumn("value", value)


def redelivered(log: DataFrame) -> DataFrame:
    """The same log with some records sent again: at later offsets, and with a later send time."""
    key = F.col("key").cast("bigint")
    copies = F.when(F.pmod(key, F.lit(20)) == 1, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    sent = F.regexp_extract("value", r'"ts_ms":([0-9]+)\}\}$', 1).cast("bigint") + F.col("_copy") * MINUTE_MS
    again = F.concat(F.regexp_replace("value", r"[0-9]+\}\}$", ""), sent.cast("string"), F.lit("}}"))
    return (
        log.withColumn("_copy", F.explode(copies))
        .withColumn("offset", F.col("offset") + F.col("_copy") * F.lit(1 << 40))
        .withColumn("value", F.when(F.col("_copy") == 0, F.col("value")).otherwise(again))
        .drop("_copy")
    )
