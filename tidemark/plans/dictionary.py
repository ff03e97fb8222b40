"""Data dictionary: one row per column of every table of the lakehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.domain import KEYS

_BRONZE = {
    "op": "Kind of change: c create, u update, r snapshot read, d delete.",
    "lsn": "Position in the source's write-ahead log; decides which change is newer.",
    "ts_ms": "Commit time at the source, epoch milliseconds; second ordering key.",
    "kafka_offset": "Offset of the record in its log partition; last ordering key.",
    "kafka_partition": "Log partition of the record; lineage only.",
}
_BRONZE_TAIL = {"raw_payload": "The row as JSON text: new image, or old image of a delete."}
_DELETED = {"is_deleted": "True if the newest change is a delete; the row is kept."}

_STAGING = {
    "stg_orders": {
        "order_id": "Order, one row each.",
        "user_id": "Buyer; joins to the customers.",
        "status": "Lifecycle status after the newest change.",
        "total_amount": "Order amount.",
        "created_at": "When the order was placed; not an ordering key for changes.",
        **_DELETED,
    },
    "stg_users": {
        "user_id": "Customer, one row each.",
        "full_name": "Name of the customer.",
        "city": "City of the customer.",
        "created_at": "When the customer was created.",
        **_DELETED,
    },
    "stg_products": {
        "product_id": "Product, one row each.",
        "name": "Name of the product.",
        "category": "Category of the product.",
        "price": "List price.",
        **_DELETED,
    },
    "stg_order_items": {
        "order_item_id": "Order line, one row each.",
        "order_id": "Order of the line.",
        "product_id": "Product of the line.",
        "quantity": "Units ordered.",
        "unit_price": "Price per unit at the time of the order.",
        **_DELETED,
    },
}
_SILVER = {
    "core_orders": {
        "order_id": "Order, one row each.",
        "user_id": "Buyer; joins to the customers.",
        "full_name": "Name of the customer.",
        "city": "City of the customer.",
        "status": "Lifecycle status.",
        "total_amount": "Order amount.",
        "created_at": "When the order was placed.",
        **_DELETED,
        "paid_amount": "The amount while the status counts as revenue, else 0.",
        "is_cancelled": "1 for cancelled orders, else 0.",
        "is_returned": "1 for returned orders, else 0.",
        "is_refunded": "1 for refunded orders, else 0.",
    },
    "core_order_items": {
        "order_item_id": "Order line, one row each.",
        "order_id": "Order of the line.",
        "product_id": "Product of the line.",
        "product_name": "Name of the product.",
        "category": "Category of the product.",
        "quantity": "Units ordered.",
        "unit_price": "Price per unit.",
        "line_total": "Units times price per unit.",
        **_DELETED,
    },
}
_GOLD = {
    "mart_daily_revenue": {
        "order_date": "UTC day on which the orders were placed.",
        "total_orders": "Live orders of the day.",
        "total_revenue": "Recognised revenue of the day.",
        "cancelled_orders": "Cancelled orders of the day.",
        "unique_customers": "Customers with an order on the day.",
    },
    "mart_sales_by_category": {
        "category": "What the sold products are filed under, one row each.",
        "total_orders": "Live revenue orders with a line in the category.",
        "total_quantity": "Units sold.",
        "total_revenue": "Sum of the line totals.",
    },
}
_OPS = {
    "stock_alerts": {
        "product_id": "Product that ran low.",
        "stock_qty": "Stock at the alert.",
        "threshold": "Stock below this value raises the alert.",
        "alert_time": "When the alert was raised.",
    },
}
_META = {
    "data_dictionary": {
        "table_name": "Namespace and name of the table.",
        "column_name": "Column of the table.",
        "description": "What the column holds.",
    },
}


def descriptions() -> dict[str, dict[str, str]]:
    """Table -> column -> description, with qualified table names."""
    bronze = {
        f"bronze.{entity}": {**_BRONZE, key: "Key of the row, also for deletes.", **_BRONZE_TAIL}
        for entity, key in KEYS.items()
    }
    layers = (("staging", _STAGING), ("silver", _SILVER), ("gold", _GOLD), ("ops", _OPS), ("meta", _META))
    return bronze | {f"{layer}.{table}": columns for layer, tables in layers for table, columns in tables.items()}


def data_dictionary(spark: SparkSession) -> DataFrame:
    rows = [(table, column, text) for table, columns in descriptions().items() for column, text in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, description string")
