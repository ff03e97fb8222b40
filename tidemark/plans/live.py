"""Live metrics: every change becomes signed deltas, and metrics are their sums.

Deltas need nothing but the change itself (its before and after image), so the same
projection feeds a batch sum, a stream's running sum, or a merge of partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.domain import (
    CREATE_OPS,
    DEFAULT_CITY,
    DEFAULT_STATUS,
    TRENDING_MINUTES,
)
from tidemark.functions.columns import event_minute, event_time, is_revenue, or_default, percent
from tidemark.functions.envelope import commit_times, images
from tidemark.operators.state import stage_of

ORDER_IMAGE = "order_id:string, user_id:string, status:string, total_amount:string"
ITEM_IMAGE = "order_item_id:string, product_id:string, quantity:string"

TOTAL, STATUS, REVENUE, BY_USER = "orders_total", "orders_status", "revenue_net", "orders_by_user"
BY_CITY, EVENTS = "orders_by_city", "events_processed"

MONEY = "decimal(38,2)"


def order_changes(log: DataFrame) -> DataFrame:
    return images(log, ORDER_IMAGE)


def item_changes(log: DataFrame) -> DataFrame:
    return images(log, ITEM_IMAGE)


def _present(image: Column) -> Column:
    """An image with at least one known field; an empty object counts as missing."""
    return F.coalesce(
        image["order_id"], image["user_id"], image["status"], image["total_amount"]
    ).isNotNull()


def _counted() -> Column:
    """A change with an operation or a time was sent by the source, whatever it holds."""
    return F.coalesce(F.col("op"), F.col("ts_ms").cast("string")).isNotNull()


def order_moves(changes: DataFrame, by_user: bool = True) -> DataFrame:
    """Order changes summed by what decides their effect: kind, old and new status.

    There are few such combinations, so almost all of the summing happens in the map
    tasks. With ``by_user`` new orders are also kept apart by customer.
    """
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    kind = (
        F.when(F.col("topic") != "orders", "void")
        .when(op.isin(*CREATE_OPS) & _present(after), "new")
        .when((op == "u") & _present(after), "changed")
        .when((op == "d") & _present(before), "gone")
        .otherwise("void")
    )
    amount = lambda image: F.coalesce(image["total_amount"].try_cast("decimal(12,2)"), F.lit(0))
    status = F.nullif(after["status"], F.lit(""))
    return (
        changes.where(_counted())
        .select(
            "topic",
            kind.alias("kind"),
            F.nullif(before["status"], F.lit("")).alias("old"),
            F.when(kind == "new", F.coalesce(status, F.lit(DEFAULT_STATUS))).otherwise(status).alias("new"),
            (F.when(kind == "new", F.coalesce(after["user_id"], F.lit(""))) if by_user else F.lit(None).cast("string")).alias("user_id"),
            amount(before).alias("old_amount"),
            amount(after).alias("new_amount"),
            "ts_ms",
        )
        .groupBy("topic", "kind", "old", "new", "user_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("old_amount").alias("old_amount"),
            F.sum("new_amount").alias("new_amount"),
            F.max("ts_ms").alias("ts_ms"),
        )
    )


def _delta(metric: str, key: Column, change: Column, when: Column) -> Column:
    row = F.struct(F.lit(metric).alias("metric"), key.alias("key"), change.cast(MONEY).alias("delta"))
    return F.when(when, row)


def order_deltas(changes: DataFrame, by_user: bool = True) -> DataFrame:
    """(metric, key, delta, ts_ms) rows of order changes.

    * an order is counted once, when it is created or read in a snapshot;
    * a status moves one from the old to the new value, if both are known and differ;
    * revenue is added on entry into a revenue status and taken back on leaving it, by
      the new image's amount; a delete takes back the old image's amount;
    * with no before image the old status is unknown: no status moves, revenue is added;
    * any change at all counts as an event of its topic, and those of topics other than
      orders as nothing else.
    """
    kind, old, new, n = F.col("kind"), F.col("old"), F.col("new"), F.col("n")
    created, updated, deleted = kind == "new", kind == "changed", kind == "gone"
    moved = updated & (old != new)
    entered = updated & is_revenue(new) & ~is_revenue(old)
    left = updated & is_revenue(old) & ~is_revenue(new)
    none = F.lit("")

    deltas = F.array(
        _delta(EVENTS, F.col("topic"), n, F.lit(True)),
        _delta(TOTAL, none, n, created),
        _delta(STATUS, new, n, created | moved),
        _delta(STATUS, old, -n, moved | (deleted & old.isNotNull())),
        _delta(BY_USER, F.col("user_id"), n, created & F.lit(by_user)),
        _delta(REVENUE, none, F.col("new_amount"), (created & is_revenue(new)) | entered),
        _delta(REVENUE, none, -F.col("new_amount"), left),
        _delta(REVENUE, none, -F.col("old_amount"), deleted & is_revenue(old)),
    )
    found = F.filter(deltas, lambda d: d.isNotNull())
    return order_moves(changes, by_user).select("ts_ms", F.explode(found).alias("d")).select("d.*", "ts_ms")


def event_deltas(log: DataFrame) -> DataFrame:
    """The event counts alone, for topics that feed no other metric."""
    counts = commit_times(log).where(_counted()).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("ts_ms")
    )
    return counts.select(
        F.lit(EVENTS).alias("metric"), F.col("topic").alias("key"), F.col("n").cast(MONEY).alias("delta"), "ts_ms"
    )


def sum_deltas(deltas: DataFrame) -> DataFrame:
    """The metric table. Partial sums before the shuffle make hot metrics cheap."""
    return deltas.groupBy("metric", "key").agg(
        F.sum("delta").cast(MONEY).alias("value"), F.max("ts_ms").alias("newest_ms")
    )


def merge_sums(sums: DataFrame) -> DataFrame:
    """One metric table out of several stacked ones."""
    return sums.groupBy("metric", "key").agg(
        F.sum("value").cast(MONEY).alias("value"), F.max("newest_ms").alias("newest_ms")
    )


def order_total(changes: DataFrame) -> DataFrame:
    return _metric(changes, TOTAL).select(F.col("value").cast("bigint").alias("orders_total"))


def status_counts(changes: DataFrame) -> DataFrame:
    return _metric(changes, STATUS).select(F.col("key").alias("status"), F.col("value").cast("bigint").alias("n"))


def net_revenue(changes: DataFrame) -> DataFrame:
    return _metric(changes, REVENUE).select(F.col("value").alias("revenue_net"))


def _metric(changes: DataFrame, metric: str) -> DataFrame:
    return sum_deltas(order_deltas(changes, by_user=False).where(F.col("metric") == metric))


def user_city(users: DataFrame) -> DataFrame:
    """Dimension of live users: id and city."""
    return users.where(~F.col("is_deleted")).select(
        "user_id", or_default(F.col("city"), DEFAULT_CITY).alias("city")
    )


def product_name(products: DataFrame) -> DataFrame:
    """Dimension of live products: id and display name."""
    return products.where(~F.col("is_deleted")).select(
        "product_id", or_default(F.col("name"), _number(F.col("product_id"))).alias("name")
    )


def _number(product_id: Column) -> Column:
    return F.concat(F.lit("#"), product_id.cast("string"))


def by_city(metrics: DataFrame, cities: DataFrame) -> DataFrame:
    """Created orders per city, from the per-user counts.

    Counting per user first means the join sees one row per customer, not per order.
    """
    per_user = metrics.where(F.col("metric") == BY_USER).select(
        F.col("key").try_cast("bigint").alias("user_id"), "value", "newest_ms"
    )
    city = F.coalesce("city", F.lit(DEFAULT_CITY))
    return (
        per_user.join(cities, "user_id", "left")
        .groupBy(city.alias("city"))
        .agg(F.sum("value").cast("bigint").alias("n"), F.max("newest_ms").alias("newest_ms"))
    )


def with_cities(sums: DataFrame, cities: DataFrame) -> DataFrame:
    """The metric table with per-user counts turned into per-city counts.

    All rows pass through the one join, those of other metrics without a match, so that
    the sums are worked out once and not per kind of metric.
    """
    of_user = F.col("metric") == BY_USER
    joined = sums.withColumn("user_id", F.when(of_user, F.col("key").try_cast("bigint"))).join(
        cities, "user_id", "left"
    )
    key = F.when(of_user, F.coalesce("city", F.lit(DEFAULT_CITY))).otherwise(F.col("key"))
    metric = F.when(of_user, BY_CITY).otherwise(F.col("metric"))
    return merge_sums(joined.select(metric.alias("metric"), key.alias("key"), "value", "newest_ms"))


def live_metrics(order_log: DataFrame, other_logs: DataFrame, users: DataFrame) -> DataFrame:
    """The whole metric table (metric, key, value, newest_ms), each log read once."""
    deltas = order_deltas(order_changes(order_log)).unionByName(event_deltas(other_logs))
    return with_cities(sum_deltas(deltas), user_city(users))


def events_processed(metrics: DataFrame) -> DataFrame:
    """Changes seen over all topics, and the commit time of the newest."""
    return metrics.where(F.col("metric") == EVENTS).agg(
        F.sum("value").cast("bigint").alias("events_processed"), event_time(F.max("newest_ms")).alias("updated_at")
    )


def last_minute(metrics: DataFrame) -> DataFrame:
    """The newest event minute of orders and lines, the anchor of the trending window."""
    facts = (F.col("metric") == EVENTS) & F.col("key").isin("orders", "order_items")
    return metrics.where(facts).agg(event_minute(F.max("newest_ms")).alias("minute"))


def sales(changes: DataFrame) -> DataFrame:
    """Units sold with their event time: new lines only, incomplete ones skipped."""
    after = F.col("after")
    return changes.where(F.col("op").isin(*CREATE_OPS)).select(
        event_time(F.col("ts_ms")).alias("sold_at"),
        after["product_id"].try_cast("bigint").alias("product_id"),
        after["quantity"].try_cast("bigint").alias("quantity"),
    ).where("product_id is not null and quantity is not null and sold_at is not null")


def trending_minute(changes: DataFrame) -> DataFrame:
    """Units per product and minute; also valid on a stream."""
    minute = F.window("sold_at", "1 minute")["start"]
    return (
        sales(changes)
        .groupBy(minute.alias("minute"), "product_id")
        .agg(F.sum("quantity").alias("units"))
    )


def within(time: Column, anchor: DataFrame, window: int) -> Column:
    """Whether a time lies in the ``window`` minutes that end with the anchor minute."""
    last = anchor.scalar()
    return (time > last - F.make_dt_interval(mins=F.lit(window))) & (time < last + F.make_dt_interval(mins=F.lit(1)))


def trending_top(
    minutes: DataFrame, anchor: DataFrame, bronze_products: DataFrame, window: int = TRENDING_MINUTES, k: int = 10
) -> DataFrame:
    """Best sellers of the window that ends at the anchor minute; ties by product id."""
    best = (
        minutes.where(within(F.col("minute"), anchor, window))
        .groupBy("product_id")
        .agg(F.sum("units").alias("units"))
        .orderBy(F.desc("units"), "product_id")
        .limit(k)
    )
    names = product_name(stage_of(bronze_products, "products", best, "name"))
    named = best.join(names, "product_id", "left")
    return named.select(
        "product_id", F.coalesce("name", _number(F.col("product_id"))).alias("name"), "units"
    ).orderBy(F.desc("units"), "product_id")


def trending_sliding(minutes: DataFrame, window: int = TRENDING_MINUTES) -> DataFrame:
    """Units of the window ending at each minute in which the product sold.

    The input holds one row per product and minute, so a product's share is bounded by
    the time span, however many sales stand behind it.
    """
    seconds = F.unix_timestamp("minute")
    frame = Window.partitionBy("product_id").orderBy(seconds).rangeBetween(-(window - 1) * 60, 0)
    return minutes.select("minute", "product_id", F.sum("units").over(frame).alias("window_units"))


def live_summary(metrics: DataFrame, top: DataFrame) -> DataFrame:
    """The dashboard, as (section, position, label, value) rows; the commit time of the newest
    change, in milliseconds, among them.

    ``metrics`` is the published table: it is read several times here.
    """
    value = F.col("value").cast(MONEY)
    total = F.sum(F.when(F.col("metric") == TOTAL, F.col("value")))
    delivered = F.sum(
        F.when((F.col("metric") == STATUS) & (F.col("key") == "DELIVERED"), F.col("value"))
    )
    rate = metrics.agg(
        percent(F.coalesce(delivered, F.lit(0)), F.coalesce(total, F.lit(0))).cast(MONEY).alias("value")
    ).select(F.lit("delivered_rate").alias("section"), F.lit(1).alias("position"), F.lit("").alias("label"), "value")
    ranked = Window.partitionBy("metric").orderBy(F.desc("value"), "key")
    rows = metrics.select(
        F.col("metric").alias("section"),
        F.row_number().over(ranked).alias("position"),
        F.col("key").alias("label"),
        value.alias("value"),
    )
    by_units = Window.orderBy(F.desc("units"), "product_id")  # over the top-k rows only
    trending = top.select(
        F.lit("trending").alias("section"),
        F.row_number().over(by_units).alias("position"),
        F.col("name").alias("label"),
        F.col("units").cast(MONEY).alias("value"),
    )
    updated = metrics.where(F.col("metric") == EVENTS).agg(F.max("newest_ms").cast(MONEY).alias("value"))
    updated = updated.select(F.lit("updated_ms").alias("section"), F.lit(1).alias("position"), F.lit("").alias("label"), "value")
    return rows.unionByName(rate).unionByName(trending).unionByName(updated)


def drift(metrics: DataFrame, core_orders: DataFrame) -> DataFrame:
    """Live against batch: counts per status and revenue, with the difference.

    Amounts changed while an order was already paid, and orders deleted, explain it.
    """
    live = metrics.where(F.col("metric").isin(STATUS, REVENUE)).select(
        "metric", "key", F.col("value").alias("live")
    )
    per_status = core_orders.where(~F.col("is_deleted")).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("paid_amount").alias("paid")
    )
    count = F.struct(F.lit(STATUS).alias("metric"), F.col("status").alias("key"), F.col("n").cast(MONEY).alias("batch"))
    paid = F.struct(F.lit(REVENUE).alias("metric"), F.lit("").alias("key"), F.col("paid").cast(MONEY).alias("batch"))
    batch = (
        per_status.select(F.inline(F.array(count, paid)))
        .groupBy("metric", "key")
        .agg(F.sum("batch").cast(MONEY).alias("batch"))
    )
    both = live.join(batch, ["metric", "key"], "full_outer")
    return both.select(
        "metric",
        "key",
        F.coalesce("live", F.lit(0)).cast(MONEY).alias("live"),
        F.coalesce("batch", F.lit(0)).cast(MONEY).alias("batch"),
        (F.coalesce("live", F.lit(0)) - F.coalesce("batch", F.lit(0))).cast(MONEY).alias("drift"),
    )
