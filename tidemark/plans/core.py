"""Silver: business entities with their descriptive attributes and derived flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import flag, paid_amount
from tidemark.operators.state import active


def order_flags(orders: DataFrame) -> DataFrame:
    """Recognised revenue and status indicators, from the order alone."""
    status = F.col("status")
    return orders.select(
        "*",
        paid_amount(status, F.col("total_amount")).alias("paid_amount"),
        flag(status == "CANCELLED").alias("is_cancelled"),
        flag(status == "RETURNED").alias("is_returned"),
        flag(status == "REFUNDED").alias("is_refunded"),
    )


def core_orders(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Every order, deleted ones flagged, with its customer's name and city.

    No join hint: Spark broadcasts the users while they are small enough. Beyond that it
    splits the orders of a hot customer (adaptive skew join), if both inputs are tables:
    a staging plan brings the partitioning of its ranking along, and then there is no
    shuffle of the join's own to split.
    """
    customer = users.select("user_id", "full_name", "city")
    return order_flags(orders).join(customer, "user_id", "left").select(
        "order_id",
        "user_id",
        "full_name",
        "city",
        "status",
        "total_amount",
        "created_at",
        "is_deleted",
        "paid_amount",
        "is_cancelled",
        "is_returned",
        "is_refunded",
    )


def core_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Every order line, deleted ones flagged, with its product and line total."""
    product = products.select("product_id", F.col("name").alias("product_name"), "category")
    return items.join(product, "product_id", "left").select(
        "order_item_id",
        "order_id",
        "product_id",
        "product_name",
        "category",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        "is_deleted",
    )


def order_header(orders: DataFrame, users: DataFrame, order_id: int | None = None) -> DataFrame:
    """Order screen, upper part: live orders with their customer."""
    wanted = active(orders) if order_id is None else active(orders).where(F.col("order_id") == order_id)
    return wanted.drop("is_deleted").join(
        active(users).select("user_id", "full_name", "city"), "user_id"
    )


def order_lines(header: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Order screen, lower part: one row per line, with its order and product.

    Lines stay rows instead of a nested list, and the joins are inner ones, so an order
    may have any number of lines: adaptive execution can split it over tasks.
    """
    lines = active(items).join(active(products).select("product_id", "name", "category"), "product_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "name",
        "category",
        "quantity",
        "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("line_total"),
    )
    return header.join(lines, "order_id")
