"""The store's vocabulary: fixed values, table shapes and column descriptions."""

from __future__ import annotations

# Change operations (snapshot read, create, update, delete).
OPS = ("c", "u", "r", "d")
CREATE_OPS = ("c", "r")

# Order lifecycle, and the part of it in which money counts as revenue.
STATUSES = (
    "CREATED", "PAID", "PREPARING", "SHIPPED",
    "DELIVERED", "CANCELLED", "RETURNED", "REFUNDED",
)
REVENUE_STATUSES = ("PAID", "PREPARING", "SHIPPED", "DELIVERED")

# Defaults for missing attributes, alert threshold, trending window.
DEFAULT_STATUS = "CREATED"
DEFAULT_CITY = "Unknown"
LOW_STOCK = 10
TRENDING_MINUTES = 60
TRENDING_GRACE_MINUTES = 10
RECONCILE_TOLERANCE = "0.01"

# City weights (population in thousands).
CITY_WEIGHTS = (
    ("Istanbul", 15907),
    ("Ankara", 5803),
    ("Izmir", 4479),
    ("Bursa", 3214),
    ("Antalya", 2696),
    ("Konya", 2296),
    ("Adana", 2270),
    ("Gaziantep", 2154),
    ("Mersin", 1917),
    ("Kayseri", 1453),
    ("Samsun", 1379),
    ("Eskisehir", 915),
)

#: Entity -> key column. These are the topics landed in bronze.
KEYS = {
    "orders": "order_id",
    "users": "user_id",
    "products": "product_id",
    "order_items": "order_item_id",
}
INVENTORY = "inventory"
TOPICS = (*KEYS, INVENTORY)

#: Entity -> {column: (path in the payload, type)}: schema on read, one line per column.
FIELDS = {
    "orders": {
        "user_id": ("$.user_id", "bigint"),
        "status": ("$.status", "string"),
        "total_amount": ("$.total_amount", "decimal(12,2)"),
        "created_at": ("$.created_at", "timestamp"),
    },
    "users": {
        "full_name": ("$.full_name", "string"),
        "city": ("$.city", "string"),
        "created_at": ("$.created_at", "timestamp"),
    },
    "products": {
        "name": ("$.name", "string"),
        "category": ("$.category", "string"),
        "price": ("$.price", "decimal(10,2)"),
    },
    "order_items": {
        "order_id": ("$.order_id", "bigint"),
        "product_id": ("$.product_id", "bigint"),
        "quantity": ("$.quantity", "bigint"),
        "unit_price": ("$.unit_price", "decimal(10,2)"),
    },
}

LOG_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)


def bronze_schema(key: str) -> str:
    return (
        "op string, lsn bigint, ts_ms bigint, kafka_offset bigint, kafka_partition int, "
        f"{key} bigint, raw_payload string"
    )


ALERT_SCHEMA = "product_id bigint, stock_qty int, threshold int, alert_time timestamp"
