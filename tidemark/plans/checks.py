"""The lakehouse's data checks: 70 on columns and 4 assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.domain import KEYS, RECONCILE_TOLERANCE, STATUSES
from tidemark.operators.quality import Check, report
from tidemark.operators.state import active

#: Lines may be landed before their orders: some orphans are normal, many are not.
ORPHAN_LIMIT = 500

_NOT_NULL = {
    **{f"bronze.{entity}": (key,) for entity, key in KEYS.items()},
    "stg_orders": ("order_id", "user_id", "status", "total_amount", "created_at", "is_deleted"),
    "stg_users": ("user_id", "full_name", "city", "is_deleted"),
    "stg_products": ("product_id", "name", "category", "price", "is_deleted"),
    "stg_order_items": ("order_item_id", "order_id", "product_id", "quantity", "unit_price", "is_deleted"),
    "core_orders": (
        "order_id", "user_id", "status", "is_deleted", "paid_amount",
        "is_cancelled", "is_returned", "is_refunded",
    ),
    "core_order_items": ("order_item_id", "order_id", "product_id", "line_total", "is_deleted"),
    "mart_daily_revenue": (
        "order_date", "total_orders", "total_revenue", "cancelled_orders", "unique_customers",
    ),
    "mart_sales_by_category": ("category", "total_orders", "total_quantity", "total_revenue"),
    "data_dictionary": ("table_name", "column_name", "description"),
}
_UNIQUE = {
    "stg_orders": "order_id",
    "stg_users": "user_id",
    "stg_products": "product_id",
    "stg_order_items": "order_item_id",
    "core_orders": "order_id",
    "core_order_items": "order_item_id",
    "mart_daily_revenue": "order_date",
    "mart_sales_by_category": "category",
}
_FLAGS = (0, 1)
_BOOLEANS = (True, False)
_ACCEPTED = (
    ("stg_orders", "status", STATUSES),
    ("core_orders", "status", STATUSES),
    ("core_orders", "is_deleted", _BOOLEANS),
    ("core_orders", "is_cancelled", _FLAGS),
    ("core_orders", "is_returned", _FLAGS),
    ("core_orders", "is_refunded", _FLAGS),
    ("core_order_items", "is_deleted", _BOOLEANS),
)
_RELATIONSHIPS = (
    ("stg_order_items", "order_id", "stg_orders", ORPHAN_LIMIT),
    ("stg_order_items", "product_id", "stg_products", 0),
    ("core_orders", "user_id", "stg_users", 0),
    ("core_order_items", "order_id", "stg_orders", ORPHAN_LIMIT),
    ("core_order_items", "product_id", "stg_products", 0),
)
_ASSERTIONS = (
    ("mart_sales_by_category", "category_non_negative"),
    ("mart_daily_revenue", "daily_counts"),
    ("mart_daily_revenue", "daily_non_negative"),
    ("mart_daily_revenue", "revenue_reconciliation"),
)

CHECKS = (
    *(Check(t, "not_null", c) for t, columns in _NOT_NULL.items() for c in columns),
    *(Check(t, "unique", c) for t, c in _UNIQUE.items()),
    *(Check(t, "accepted_values", c, values=v) for t, c, v in _ACCEPTED),
    *(
        Check(t, "relationships", c, parent=p, parent_column=c, error=limit)
        for t, c, p, limit in _RELATIONSHIPS
    ),
    *(Check(t, "assertion", name) for t, name in _ASSERTIONS),
)


#: Assertions about single rows of a mart: rows for which these hold break them.
ROW_RULES = {
    "category_non_negative": "total_quantity < 0 or total_revenue < 0",
    "daily_counts": "cancelled_orders > total_orders or unique_customers > total_orders",
    "daily_non_negative": "total_revenue < 0",
}


def row_rules(table: str) -> dict[str, Column]:
    """The assertions about single rows of ``table``, by check name."""
    return {f"assertion:{t}.{name}": F.expr(ROW_RULES[name]) for t, name in _ASSERTIONS if t == table and name in ROW_RULES}


def category_non_negative(by_category: DataFrame) -> DataFrame:
    return by_category.where(ROW_RULES["category_non_negative"]).select(
        "category", "total_quantity", "total_revenue"
    )


def daily_counts(daily: DataFrame) -> DataFrame:
    return daily.where(ROW_RULES["daily_counts"]).select(
        "order_date", "total_orders", "cancelled_orders", "unique_customers"
    )


def daily_non_negative(daily: DataFrame) -> DataFrame:
    return daily.where(ROW_RULES["daily_non_negative"]).select("order_date", "total_revenue")


def revenue_reconciliation(daily: DataFrame, orders: DataFrame, only_active: bool = False) -> DataFrame:
    """Days on which the mart's revenue differs from the orders' by more than a cent.

    Deleted orders count on the silver side unless ``only_active``; the mart leaves
    them out, so a deleted order that still carries revenue shows up here.
    """
    source = active(orders) if only_active else orders
    silver = source.groupBy(F.to_date("created_at").alias("order_date")).agg(F.sum("paid_amount").alias("revenue"))
    mart = daily.select("order_date", "total_revenue")
    both = mart.join(silver.withColumnRenamed("order_date", "silver_date"), F.col("order_date") == F.col("silver_date"), "full_outer")
    gap = F.abs(F.coalesce("total_revenue", F.lit(0)) - F.coalesce("revenue", F.lit(0)))
    # A day that only the orders know comes without a date, as the mart has none for it.
    return both.where(gap > F.lit(RECONCILE_TOLERANCE).cast("decimal(4,2)")).select(
        "order_date", "total_revenue", "revenue", F.abs(F.col("total_revenue") - F.col("revenue")).alias("diff")
    )


def dq_report(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    checks: tuple[Check, ...] = CHECKS,
    counted: dict[str, int] | None = None,
) -> DataFrame:
    """Every declared check; ``counted`` has what the writes of the tables have counted already."""
    daily, category = tables["mart_daily_revenue"], tables["mart_sales_by_category"]
    violators = {
        "assertion:mart_sales_by_category.category_non_negative": category_non_negative(category),
        "assertion:mart_daily_revenue.daily_counts": daily_counts(daily),
        "assertion:mart_daily_revenue.daily_non_negative": daily_non_negative(daily),
        "assertion:mart_daily_revenue.revenue_reconciliation": revenue_reconciliation(daily, tables["core_orders"]),
    }
    return report(spark, checks, tables, violators, counted)
