"""Analyses over history and state: audit, lead times, funnel, burn rate, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.domain import DEFAULT_CITY
from tidemark.functions.columns import event_time, percent
from tidemark.functions.envelope import MONTH, extract
from tidemark.operators.scans import carry_forward, landed, previous
from tidemark.operators.state import LOG_ORDER, active, latest_rows, soft_delete, stage_of
from tidemark.plans.marts import sales_by_category


def order_history(bronze_orders: DataFrame) -> DataFrame:
    """Each change of an order with the status before it, for audit.

    A change that was delivered more than once is listed once; copies are collapsed by a
    grouping, in the map tasks, before an order's changes are put in order.
    """
    events = extract(bronze_orders, {"status": ("$.status", "string")})
    changes = events.groupBy("order_id", "lsn", "ts_ms", "op", "status").agg(
        F.min("kafka_offset").alias("kafka_offset")
    )
    with_before = previous(landed(changes), "order_id", LOG_ORDER, "status", "old_status")
    return with_before.select(
        "order_id",
        "lsn",
        "op",
        event_time(F.col("ts_ms")).alias("changed_at"),
        "old_status",
        F.col("status").alias("new_status"),
        (~F.col("status").eqNullSafe(F.col("old_status"))).alias("is_transition"),
    )


def time_to_payment(bronze_orders: DataFrame) -> DataFrame:
    """Paid orders and their average seconds from the first CREATED to the first PAID."""
    events = extract(bronze_orders.where(F.col("op") != "d"), {"status": ("$.status", "string")})
    first = lambda status: F.min(F.when(F.col("status") == status, F.col("ts_ms")))
    orders = events.groupBy("order_id").agg(
        first("CREATED").alias("created_ms"), first("PAID").alias("paid_ms")
    )
    wait = F.col("paid_ms") - F.col("created_ms")
    return orders.where(wait.isNotNull()).agg(
        F.count(F.lit(1)).alias("paid_orders"),
        (F.sum(wait.cast("decimal(20,0)")) / F.count(F.lit(1)) / 1000).cast("decimal(20,3)").alias("avg_seconds"),
    )


def cancellations_by_city(core_orders: DataFrame) -> DataFrame:
    return active(core_orders).groupBy("city").agg(
        F.count("order_id").alias("total_orders"), F.sum("is_cancelled").alias("cancelled_orders")
    )


def order_funnel(orders: DataFrame) -> DataFrame:
    """How far live orders got, and the shares of unpaid carts and returned sales."""
    status = F.col("status")
    reached = lambda *names: F.count_if(status.isin(*names))
    came_back = reached("RETURNED")
    return (
        active(orders)
        .agg(
            F.count("order_id").alias("placed"),
            reached("CREATED").alias("unpaid_carts"),
            reached("CANCELLED").alias("cancelled"),
            reached("PAID").alias("paid"),
            reached("PREPARING").alias("preparing"),
            reached("SHIPPED").alias("shipped"),
            reached("DELIVERED").alias("delivered"),
            came_back.alias("returned"),
            reached("REFUNDED").alias("refunded"),
        )
        .withColumn("unpaid_pct", percent(F.col("unpaid_carts"), F.col("placed")))
        .withColumn(
            "return_pct", percent(F.col("returned"), F.col("returned") + F.col("delivered"))
        )
    )


def burn_rate(readings: DataFrame) -> DataFrame:
    """Units sold per day and days until stock-out, per product.

    A fall between two readings is a sale, a rise is a restock. ``readings`` has
    product_id, stock_qty, ts_ms and kafka_offset.
    """
    steps = previous(landed(readings), "product_id", ["kafka_offset"], "stock_qty", "before_qty")
    sold = F.greatest(F.col("before_qty") - F.col("stock_qty"), F.lit(0))
    day = F.to_date(event_time(F.col("ts_ms")))
    per_product = steps.groupBy("product_id").agg(
        F.coalesce(F.sum(sold), F.lit(0)).cast("bigint").alias("units_sold"),
        (F.date_diff(F.max(day), F.min(day)) + 1).cast("bigint").alias("days"),
        F.max_by("stock_qty", "kafka_offset").alias("stock_qty"),
    )
    rate = F.col("units_sold").cast("decimal(18,0)") / F.col("days").cast("decimal(9,0)")
    left = F.col("stock_qty").cast("decimal(18,0)") * F.col("days") / F.col("units_sold")
    return per_product.select(
        "product_id",
        "stock_qty",
        "units_sold",
        "days",
        F.round(rate.cast("double"), 6).alias("units_per_day"),
        F.when(F.col("units_sold") > 0, F.round(left.cast("double"), 3)).alias("days_left"),
    )


def top_customers(orders: DataFrame, bronze_users: DataFrame, k: int = 10) -> DataFrame:
    """The customers with the most recognised spend; ranked first, named after."""
    best = (
        active(orders)
        .groupBy("user_id")
        .agg(F.sum("paid_amount").alias("spend"), F.count("order_id").alias("orders"))
        .orderBy(F.desc("spend"), "user_id")
        .limit(k)
    )
    names = stage_of(bronze_users, "users", best, "full_name", "city")
    named = best.join(names, "user_id", "left")
    return named.select("user_id", "full_name", "city", "spend", "orders").orderBy(F.desc("spend"), "user_id")


def cancelled_recently(bronze_orders: DataFrame, hours: int = 1) -> DataFrame:
    """Orders cancelled within the last hours of the log's own clock."""
    end = bronze_orders.agg(F.max("ts_ms").alias("end_ms"))
    first = end.scalar() - hours * 3_600_000
    recent = bronze_orders.where(F.col("op") != "d").where(F.col("ts_ms") > first)
    if MONTH in recent.columns:  # months before are not read
        recent = recent.where(F.col(MONTH) >= F.to_date(F.date_trunc("month", F.timestamp_millis(first))))
    events = extract(recent, {"user_id": ("$.user_id", "bigint"), "status": ("$.status", "string")})
    return (
        events.where(F.col("status") == "CANCELLED")
        .groupBy("order_id", "user_id")
        .agg(event_time(F.min("ts_ms")).alias("cancelled_at"))
    )


def best_category_of_last_month(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Category with the highest revenue among the newest calendar month's orders."""
    month = F.trunc("created_at", "month")
    last = active(orders).agg(F.max(month).alias("m"))
    ranked = sales_by_category(items, orders.where(month == last.scalar()))
    return ranked.orderBy(F.desc("total_revenue"), "category").limit(1)


def recent_orders(orders: DataFrame, k: int = 30) -> DataFrame:
    """The newest live orders, by id."""
    return active(orders).select("order_id", "status", "total_amount").orderBy(F.desc("order_id")).limit(k)


def first_users(users: DataFrame, k: int = 500) -> DataFrame:
    """The first live users with a display label."""
    label = F.concat(
        F.col("user_id").cast("string"), F.lit(" · "), F.col("full_name"), F.lit(" ("), F.col("city"), F.lit(")")
    )
    return active(users).select("user_id", label.alias("label")).orderBy("user_id").limit(k)


def orders_by_city_then(creations: DataFrame, versions: DataFrame) -> DataFrame:
    """Created orders per city, by the customer's city when the order was placed.

    ``creations`` has user_id and lsn of new orders, ``versions`` user_id, lsn and city
    of the customers. Orders are counted per position first, so copies weigh little.
    """
    orders = creations.groupBy("user_id", "lsn").agg(F.count(F.lit(1)).alias("n"))
    history = orders.select(
        "user_id", "lsn", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("city"), "n"
    ).unionByName(
        versions.select("user_id", "lsn", F.lit(0).alias("kind"), "city", F.lit(0).cast("bigint").alias("n"))
    )
    known = carry_forward(landed(history), "user_id", ["lsn", "kind"], "city", "city_then")
    city = F.coalesce("city_then", F.lit(DEFAULT_CITY))
    return known.where("kind = 1").groupBy(city.alias("city")).agg(F.sum("n").alias("n"))


def table_counts(bronze: dict[str, DataFrame]) -> DataFrame:
    """Live rows per entity; the payload is not read for it."""
    counts = [
        active(soft_delete(latest_rows(df, entity))).agg(
            F.lit(entity).alias("table_name"), F.count(F.lit(1)).alias("n")
        )
        for entity, df in bronze.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
