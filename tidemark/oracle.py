"""The same results in ANSI SQL for DuckDB, straight from the given tables.

The SQL never sees a change log: it computes the state and the history by arithmetic on
keys, following the rules in FIXTURES.md.
"""

from __future__ import annotations

from tidemark.domain import CITY_WEIGHTS
from tidemark.registry import CUTOFF_MS
from tidemark.sources.changelog import CUT_SHORT, PARTITIONS, PATHS, WRONG_AMOUNT, WRONG_QUANTITY

_PATHS = ", ".join(f"({lo}, {hi}, {list(hops)})" for lo, hi, hops in PATHS)
_CUTS = " ".join(f"WHEN {residue} THEN {hops}" for residue, hops in CUT_SHORT)
_REVENUE = "('PAID', 'PREPARING', 'SHIPPED', 'DELIVERED')"

#: Named pieces; each query lists the ones it needs, in order of dependency.
_PARTS = {
    "paths": f"paths(lo, hi, hops) AS (VALUES {_PATHS})",
    "life": f"""life AS (
        SELECT o.*, p.hops, CAST(CASE o_orderkey % 700 {_CUTS} ELSE len(p.hops) END AS BIGINT) AS n
        FROM orders o JOIN paths p ON o.o_orderkey % 100 >= p.lo AND o.o_orderkey % 100 < p.hi)""",
    "ord": """ord AS (
        SELECT o_orderkey AS order_id, o_custkey AS user_id, hops, n, hops[n] AS status,
            o_orderdate AS created_at, epoch_ms(o_orderdate) AS created_ms,
            CAST(o_totalprice AS DECIMAL(12,2)) AS base,
            CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority,
            (o_orderkey % 20 = 3 AND hops[n] IN ('CANCELLED', 'REFUNDED')) AS is_deleted
        FROM life)""",
    "so": """so AS (
        SELECT order_id, user_id, status,
            CAST(base + CASE WHEN order_id % 250 = 40 AND n >= 4 THEN 10 ELSE 0 END AS DECIMAL(12,2)) AS total_amount,
            created_at, is_deleted
        FROM ord)""",
    "ev": """ev AS (
        SELECT ord.*, h AS hop,
            CASE WHEN h >= n THEN 'd' WHEN h = 0 THEN 'c' ELSE 'u' END AS op,
            hops[least(h + 1, n)] AS st, CASE WHEN h > 0 THEN hops[h] END AS old_st,
            (order_id + 1) * 16 + h AS lsn, created_ms + h * 3600000 AS ts_ms,
            CAST(base + CASE WHEN order_id % 250 = 40 AND least(h, n - 1) >= 3 THEN 10 ELSE 0 END AS DECIMAL(12,2)) AS amount
        FROM (SELECT *, unnest(range(n + CASE WHEN is_deleted THEN 1 ELSE 0 END)) AS h FROM ord) ord)""",
    "su": """su AS (
        SELECT c_custkey AS user_id, c_name AS full_name, t.n_name AS city,
            TIMESTAMP '1995-01-01 00:00:00' AS created_at, c_custkey % 50 = 9 AS is_deleted
        FROM customer c JOIN nation t
            ON t.n_nationkey = CASE WHEN c_custkey % 10 = 4 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END)""",
    "sp": """sp AS (
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
            CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 40 = 7 THEN 5 ELSE 0 END AS DECIMAL(10,2)) AS price,
            FALSE AS is_deleted
        FROM part)""",
    "ln": """ln AS (
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                l_quantity, l_extendedprice) AS order_item_id,
            l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
            epoch_ms(l_shipdate) + (l_orderkey % 60) * 60000 AS ts_ms
        FROM lineitem)""",
    "si": """si AS (
        SELECT ln.order_item_id, ln.order_id, ln.product_id, ln.quantity, ln.unit_price,
            ord.is_deleted, ln.ts_ms
        FROM ln JOIN ord USING (order_id))""",
    "co": f"""co AS (
        SELECT so.order_id, so.user_id, su.full_name, su.city, so.status, so.total_amount, so.created_at,
            so.is_deleted,
            CAST(CASE WHEN so.status IN {_REVENUE} THEN so.total_amount ELSE 0 END AS DECIMAL(12,2)) AS paid_amount,
            CASE WHEN so.status = 'CANCELLED' THEN 1 ELSE 0 END AS is_cancelled,
            CASE WHEN so.status = 'RETURNED' THEN 1 ELSE 0 END AS is_returned,
            CASE WHEN so.status = 'REFUNDED' THEN 1 ELSE 0 END AS is_refunded
        FROM so LEFT JOIN su USING (user_id))""",
    "ci": """ci AS (
        SELECT si.order_item_id, si.order_id, si.product_id, sp.name AS product_name, sp.category, si.quantity,
            si.unit_price, CAST(si.quantity * si.unit_price AS DECIMAL(31,2)) AS line_total, si.is_deleted
        FROM si LEFT JOIN sp USING (product_id))""",
    "daily": """daily AS (
        SELECT CAST(created_at AS DATE) AS order_date, count(order_id) AS total_orders,
            CAST(sum(paid_amount) AS DECIMAL(22,2)) AS total_revenue,
            CAST(sum(is_cancelled) AS BIGINT) AS cancelled_orders,
            count(DISTINCT user_id) AS unique_customers
        FROM co WHERE NOT is_deleted GROUP BY 1)""",
    "cat": f"""cat AS (
        SELECT ci.category, count(DISTINCT so.order_id) AS total_orders,
            CAST(sum(ci.quantity) AS BIGINT) AS total_quantity,
            CAST(sum(ci.line_total) AS DECIMAL(38,2)) AS total_revenue
        FROM ci JOIN so USING (order_id)
        WHERE so.status IN {_REVENUE} AND NOT so.is_deleted AND NOT ci.is_deleted GROUP BY 1)""",
    # Orders as the faulty source gives them.
    "fo": f"""fo AS (
        SELECT order_id, user_id,
            CASE order_id % 97 WHEN 11 THEN 'LOST' WHEN 12 THEN 'HELD' ELSE status END AS status,
            CASE WHEN order_id % 97 = 14 THEN CAST({WRONG_AMOUNT} AS DECIMAL(12,2)) ELSE total_amount END AS total_amount,
            created_at, is_deleted
        FROM so WHERE order_id % 97 <> 13)""",
    "fd": f"""fd AS (
        SELECT CAST(created_at AS DATE) AS order_date,
            CAST(sum(CASE WHEN status IN {_REVENUE} THEN total_amount ELSE 0 END) AS DECIMAL(22,2)) AS total_revenue
        FROM fo WHERE NOT is_deleted GROUP BY 1)""",
    # Signed deltas of the live metrics.
    "dl": f"""dl AS (
        SELECT 'orders_total' AS metric, '' AS key, CAST(1 AS DECIMAL(14,2)) AS delta, ts_ms FROM ev WHERE op = 'c'
        UNION ALL SELECT 'orders_status', st, 1, ts_ms FROM ev WHERE op = 'c'
        UNION ALL SELECT 'orders_status', st, 1, ts_ms FROM ev WHERE op = 'u'
        UNION ALL SELECT 'orders_status', old_st, -1, ts_ms FROM ev WHERE op IN ('u', 'd')
        UNION ALL SELECT 'revenue_net', '', amount, ts_ms FROM ev
            WHERE op = 'u' AND st IN {_REVENUE} AND old_st NOT IN {_REVENUE}
        UNION ALL SELECT 'revenue_net', '', -amount, ts_ms FROM ev
            WHERE op = 'u' AND st NOT IN {_REVENUE} AND old_st IN {_REVENUE})""",
    "sums": """sums AS (
        SELECT metric, key, CAST(sum(delta) AS DECIMAL(38,2)) AS value, max(ts_ms) AS newest_ms
        FROM dl GROUP BY 1, 2)""",
    "city": """city AS (
        SELECT CASE WHEN su.is_deleted THEN 'Unknown' ELSE su.city END AS city, count(*) AS n,
            max(created_ms) AS newest_ms
        FROM ord JOIN su USING (user_id) GROUP BY 1)""",
    "seen": """seen AS (
        SELECT topic, count(*) AS n, max(ts_ms) AS ts_ms FROM (
            SELECT 'orders' AS topic, ts_ms FROM ev
            UNION ALL SELECT 'order_items', ts_ms FROM si
            UNION ALL SELECT 'order_items', ts_ms + 60000 FROM si WHERE is_deleted
            UNION ALL SELECT 'users', 788918400000 FROM customer
            UNION ALL SELECT 'users', 788918400000 + (c_custkey % 2000 + 1) * 86400000 FROM customer
                WHERE c_custkey % 10 = 4 OR c_custkey % 50 = 9
            UNION ALL SELECT 'products', 788918400000 FROM part
            UNION ALL SELECT 'products', 788918400000 + (p_partkey % 2000 + 1) * 86400000 FROM part WHERE p_partkey % 40 = 7)
        GROUP BY 1)""",
    "met": """met AS (
        SELECT metric, key, value, newest_ms FROM sums
        UNION ALL SELECT 'orders_by_city', city, CAST(n AS DECIMAL(38,2)), newest_ms FROM city
        UNION ALL SELECT 'events_processed', topic, CAST(n AS DECIMAL(38,2)), ts_ms FROM seen)""",
    "mi": """mi AS (
        SELECT date_trunc('minute', make_timestamp(ts_ms * 1000)) AS minute, product_id,
            CAST(sum(quantity) AS BIGINT) AS units
        FROM ln GROUP BY 1, 2)""",
    "top": """top AS (
        SELECT mi.product_id, any_value(sp.name) AS name, CAST(sum(units) AS BIGINT) AS units
        FROM mi JOIN sp USING (product_id),
            (SELECT date_trunc('minute', make_timestamp(max(ts_ms) * 1000)) AS anchor FROM (
                SELECT ts_ms FROM si UNION ALL SELECT ts_ms + 60000 FROM si WHERE is_deleted
                UNION ALL SELECT ts_ms FROM ev))
        WHERE minute > anchor - INTERVAL 60 MINUTE AND minute <= anchor
        GROUP BY 1 ORDER BY units DESC, product_id LIMIT 10)""",
    "st": """st AS (
        SELECT product_id, order_item_id, ts_ms,
            CAST(100 - CAST(sum(quantity) OVER (PARTITION BY product_id ORDER BY order_item_id) AS BIGINT) % 100 AS INTEGER)
                AS stock_qty
        FROM ln)""",
    "fall": """fall AS (
        SELECT *, lag(stock_qty) OVER (PARTITION BY product_id ORDER BY order_item_id) AS before_qty FROM st)""",
    "cut_ord": f"""cut_ord AS (
        SELECT order_id, user_id, st AS status, amount AS total_amount, created_at, op = 'd' AS is_deleted
        FROM ev WHERE ts_ms <= {CUTOFF_MS}
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) = 1)""",
    # Commit times of every change, and the one that all partitions of all logs have reached.
    "com": f"""com AS (
        SELECT 'orders' AS topic, order_id AS id, ts_ms, op = 'd' AS gone FROM ev
        UNION ALL SELECT 'order_items', order_item_id, ts_ms, FALSE FROM si
        UNION ALL SELECT 'order_items', order_item_id, ts_ms + 60000, TRUE FROM si WHERE is_deleted
        UNION ALL SELECT 'users', c_custkey, 788918400000, FALSE FROM customer
        UNION ALL SELECT 'users', c_custkey, 788918400000 + (c_custkey % 2000 + 1) * 86400000, c_custkey % 50 = 9
            FROM customer WHERE c_custkey % 10 = 4 OR c_custkey % 50 = 9
        UNION ALL SELECT 'products', p_partkey, 788918400000, FALSE FROM part
        UNION ALL SELECT 'products', p_partkey, 788918400000 + (p_partkey % 2000 + 1) * 86400000, FALSE
            FROM part WHERE p_partkey % 40 = 7)""",
    "common": f"""common AS (
        SELECT min(newest) AS cut FROM (SELECT max(ts_ms) AS newest FROM com GROUP BY topic, id % {PARTITIONS}))""",
}
_NEEDS = {
    "paths": (), "life": ("paths",), "ord": ("life",), "so": ("ord",), "ev": ("ord",), "su": (), "sp": (), "ln": (),
    "si": ("ln", "ord"), "co": ("so", "su"), "ci": ("si", "sp"), "daily": ("co",), "cat": ("ci", "so"), "fo": ("so",), "fd": ("fo",),
    "dl": ("ev",), "sums": ("dl",), "city": ("ord", "su"), "seen": ("ev", "si"), "met": ("sums", "city", "seen"),
    "mi": ("ln",), "top": ("mi", "sp", "si", "ev"), "st": ("ln",), "fall": ("st",), "cut_ord": ("ev",),
    "com": ("ev", "si"), "common": ("com",),
}


def _sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(part: str) -> None:
        for earlier in _NEEDS[part]:
            add(earlier)
        if part not in order:
            order.append(part)

    for part in needs:
        add(part)
    return (f"WITH {', '.join(_PARTS[p] for p in order)} " if order else "") + body


_METRIC_ROWS = "SELECT metric, key, value, newest_ms FROM met"
_ALERTS = """SELECT product_id, stock_qty, CAST(10 AS INTEGER) AS threshold, make_timestamp(ts_ms * 1000) AS alert_time
    FROM fall WHERE stock_qty < 10 AND (before_qty IS NULL OR before_qty >= 10)"""
_STAGED_ORDERS = "SELECT order_id, user_id, status, total_amount, created_at, is_deleted FROM so"
_MINUTES = "SELECT minute, product_id, units FROM mi"

# Table, column, kind of the declared checks; on these tables they all pass.
_WEIGHTS = ", ".join(f"('{city}', {pop})" for city, pop in CITY_WEIGHTS)


def _report(kind: str | None) -> str:
    from tidemark.plans.checks import CHECKS

    rows = ", ".join(
        f"('{c.table}', '{c.column}', '{c.kind}')" for c in CHECKS if kind in (None, c.kind)
    )
    return (
        f"SELECT table_name, column_name, kind, CAST(0 AS BIGINT) AS violations, 'pass' AS verdict "
        f"FROM (VALUES {rows}) AS t(table_name, column_name, kind)"
    )


def oracle_sql() -> dict[str, str]:
    return {
        "bronze_envelope": _sql(
            """SELECT op, lsn, ts_ms, lsn AS kafka_offset, CAST(order_id % 3 AS INTEGER) AS kafka_partition, order_id,
                '{"order_id":' || order_id || ',"user_id":' || user_id || ',"status":"' || st
                || '","total_amount":"' || amount || '","created_at":"'
                || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') || '","priority":'
                || CASE WHEN priority IS NULL THEN 'null' ELSE '"' || priority || '"' END || '}' AS raw_payload
            FROM ev""",
            "ev",
        ),
        "cdc_quarantine": _sql(
            """SELECT CASE order_id % 97 WHEN 5 THEN 'bad json' WHEN 6 THEN 'tombstone' WHEN 7 THEN 'no payload'
                    WHEN 8 THEN 'unknown op' WHEN 9 THEN 'no op' WHEN 10 THEN 'no key' END AS reason,
                CAST(order_id % 3 AS INTEGER) AS kafka_partition, count(*) AS n
            FROM ev WHERE order_id % 97 BETWEEN 5 AND 10 GROUP BY 1, 2""",
            "ev",
        ),
        "stg_orders": _sql(_STAGED_ORDERS, "so"),
        "stg_orders_redelivered": _sql(_STAGED_ORDERS, "so"),
        "incremental_orders": _sql(_STAGED_ORDERS, "so"),
        "stg_users": _sql("SELECT user_id, full_name, city, created_at, is_deleted FROM su", "su"),
        "stg_products": _sql("SELECT product_id, name, category, price, is_deleted FROM sp", "sp"),
        "stg_order_items": _sql(
            "SELECT order_item_id, order_id, product_id, quantity, unit_price, is_deleted FROM si", "si"
        ),
        "stg_orders_asof": _sql(
            "SELECT order_id, user_id, status, total_amount, created_at, is_deleted FROM cut_ord", "cut_ord"
        ),
        "cut_tables": _sql(
            """SELECT topic AS table_name, count(*) AS n, CAST(sum(gone) AS BIGINT) AS deleted,
                CAST(sum(CASE WHEN topic = 'order_items' AND created_ms > cut THEN 1 ELSE 0 END) AS BIGINT) AS waiting
            FROM (SELECT topic, id, cut, CAST(max(gone::INT) AS BIGINT) AS gone FROM com, common WHERE ts_ms <= cut GROUP BY 1, 2, 3) kept
            LEFT JOIN (SELECT order_item_id, created_ms FROM si JOIN ord USING (order_id)) line
                ON topic = 'order_items' AND order_item_id = id
            GROUP BY 1""",
            "common",
        ),
        "cut_order_items": _sql(
            f"""SELECT si.order_item_id, si.order_id, si.product_id, si.quantity, si.unit_price,
                si.is_deleted AND si.ts_ms + 60000 <= cut_ms AS is_deleted, created_ms > cut_ms AS is_waiting
            FROM si JOIN ord USING (order_id), (SELECT least(cut, {CUTOFF_MS}) AS cut_ms FROM common) WHERE si.ts_ms <= cut_ms""",
            "common",
        ),
        "late_column": _sql(
            "SELECT priority, count(*) AS n, count(DISTINCT order_id) AS orders FROM ev GROUP BY 1", "ev"
        ),
        "native_state": """
            SELECT user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
                event_id AS lsn, CAST(value AS DECIMAL(12,2)) AS measure,
                CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type = 'error' AS is_deleted
            FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
        "native_minutes": """
            SELECT date_trunc('minute', ts) AS minute,
                CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END AS op,
                count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total
            FROM events WHERE event_type <> 'error' GROUP BY 1, 2""",
        "order_flags": _sql(
            """SELECT order_id, user_id, status, total_amount, created_at, is_deleted, paid_amount,
                is_cancelled, is_returned, is_refunded FROM co""",
            "co",
        ),
        "core_orders": _sql("SELECT * FROM co", "co"),
        "core_order_items": _sql("SELECT * FROM ci", "ci"),
        "mart_daily_revenue": _sql("SELECT * FROM daily", "daily"),
        "mart_sales_by_category": _sql("SELECT * FROM cat", "cat"),
        "mart_daily_upkeep": _sql("SELECT * FROM daily", "daily"),
        "mart_category_upkeep": _sql("SELECT * FROM cat", "cat"),
        "order_header": _sql(
            """SELECT so.order_id, so.user_id, so.status, so.total_amount, so.created_at, su.full_name, su.city
            FROM so JOIN su USING (user_id) WHERE NOT so.is_deleted AND NOT su.is_deleted""",
            "so", "su",
        ),
        "order_detail": _sql(
            """SELECT so.order_id, so.user_id, so.status, so.total_amount, so.created_at, su.full_name, su.city,
                i.order_item_id, i.product_id, i.name, i.category, i.quantity, i.unit_price, i.line_total
            FROM so JOIN su USING (user_id) JOIN (
                SELECT si.order_id, order_item_id, product_id, name, category, quantity, unit_price,
                    CAST(quantity * unit_price AS DECIMAL(32,2)) AS line_total
                FROM si JOIN sp USING (product_id) WHERE NOT si.is_deleted) i USING (order_id)
            WHERE NOT so.is_deleted AND NOT su.is_deleted""",
            "so", "su", "si", "sp",
        ),
        "order_history": _sql(
            """SELECT order_id, lsn, op, make_timestamp(ts_ms * 1000) AS changed_at, old_st AS old_status,
                st AS new_status, old_st IS DISTINCT FROM st AS is_transition FROM ev""",
            "ev",
        ),
        "time_to_payment": _sql(
            """SELECT count(*) AS paid_orders, CAST(avg(paid_ms - created_ms) / 1000 AS DECIMAL(20,3)) AS avg_seconds
            FROM (SELECT order_id, min(CASE WHEN st = 'CREATED' THEN ts_ms END) AS created_ms,
                    min(CASE WHEN st = 'PAID' THEN ts_ms END) AS paid_ms
                FROM ev WHERE op <> 'd' GROUP BY 1)
            WHERE paid_ms IS NOT NULL""",
            "ev",
        ),
        "cancellations_by_city": _sql(
            """SELECT city, count(*) AS total_orders, CAST(sum(is_cancelled) AS BIGINT) AS cancelled_orders
            FROM co WHERE NOT is_deleted GROUP BY 1""",
            "co",
        ),
        "order_funnel": _sql(
            """SELECT *, CAST(round_even(CAST(unpaid_carts AS DOUBLE) / placed * 100, 0) AS BIGINT) AS unpaid_pct,
                CAST(round_even(CAST(returned AS DOUBLE) / (returned + delivered) * 100, 0) AS BIGINT) AS return_pct
            FROM (SELECT count(*) AS placed, count(*) FILTER (status = 'CREATED') AS unpaid_carts,
                    count(*) FILTER (status = 'CANCELLED') AS cancelled, count(*) FILTER (status = 'PAID') AS paid,
                    count(*) FILTER (status = 'PREPARING') AS preparing, count(*) FILTER (status = 'SHIPPED') AS shipped,
                    count(*) FILTER (status = 'DELIVERED') AS delivered, count(*) FILTER (status = 'RETURNED') AS returned,
                    count(*) FILTER (status = 'REFUNDED') AS refunded
                FROM so WHERE NOT is_deleted)""",
            "so",
        ),
        "burn_rate": _sql(
            """SELECT product_id, stock_qty, units_sold, days,
                round(CAST(units_sold AS DOUBLE) / days, 6) AS units_per_day,
                CASE WHEN units_sold > 0 THEN round(CAST(stock_qty * days AS DOUBLE) / units_sold, 3) END AS days_left
            FROM (SELECT product_id, arg_max(stock_qty, order_item_id) AS stock_qty,
                    CAST(coalesce(sum(greatest(before_qty - stock_qty, 0)), 0) AS BIGINT) AS units_sold,
                    date_diff('day', CAST(make_timestamp(min(ts_ms) * 1000) AS DATE),
                        CAST(make_timestamp(max(ts_ms) * 1000) AS DATE)) + 1 AS days
                FROM fall GROUP BY 1)""",
            "fall",
        ),
        "top_customers": _sql(
            """SELECT user_id, full_name, any_value(city) AS city, CAST(sum(paid_amount) AS DECIMAL(22,2)) AS spend,
                count(*) AS orders
            FROM co WHERE NOT is_deleted GROUP BY 1, 2 ORDER BY spend DESC, user_id LIMIT 10""",
            "co",
        ),
        "cancelled_recent": _sql(
            """SELECT order_id, user_id, make_timestamp(min(ts_ms) * 1000) AS cancelled_at
            FROM ev WHERE op <> 'd' AND st = 'CANCELLED'
                AND ts_ms > (SELECT max(ts_ms) FROM ev) - 2592000000
            GROUP BY 1, 2""",
            "ev",
        ),
        "best_category_month": _sql(
            f"""SELECT ci.category, count(DISTINCT so.order_id) AS total_orders,
                CAST(sum(ci.quantity) AS BIGINT) AS total_quantity,
                CAST(sum(ci.line_total) AS DECIMAL(38,2)) AS total_revenue
            FROM ci JOIN so USING (order_id)
            WHERE so.status IN {_REVENUE} AND NOT so.is_deleted AND NOT ci.is_deleted
                AND date_trunc('month', so.created_at) = (SELECT date_trunc('month', max(created_at)) FROM so WHERE NOT is_deleted)
            GROUP BY 1 ORDER BY total_revenue DESC, category LIMIT 1""",
            "ci", "so",
        ),
        "recent_orders": _sql(
            "SELECT order_id, status, total_amount FROM so WHERE NOT is_deleted ORDER BY order_id DESC LIMIT 30", "so"
        ),
        "first_users": _sql(
            """SELECT user_id, user_id || ' · ' || full_name || ' (' || city || ')' AS label
            FROM su WHERE NOT is_deleted ORDER BY user_id LIMIT 500""",
            "su",
        ),
        "table_counts": _sql(
            """SELECT 'orders' AS table_name, count(*) AS n FROM so WHERE NOT is_deleted
            UNION ALL SELECT 'users', count(*) FROM su WHERE NOT is_deleted
            UNION ALL SELECT 'products', count(*) FROM sp WHERE NOT is_deleted
            UNION ALL SELECT 'order_items', count(*) FROM si WHERE NOT is_deleted""",
            "so", "su", "sp", "si",
        ),
        # A point belongs to the first city, heaviest first, that together with all heavier ones outweighs it.
        "assign_weighted": f"""
            WITH w(city, pop) AS (VALUES {_WEIGHTS}),
            point AS (SELECT c_custkey, (c_custkey * 7919) % (SELECT sum(pop) FROM w) AS p FROM customer),
            reach AS (SELECT a.city, sum(b.pop) AS weight FROM w a
                JOIN w b ON b.pop > a.pop OR (b.pop = a.pop AND b.city <= a.city) GROUP BY a.city)
            SELECT c_custkey, min_by(city, weight) AS city FROM point JOIN reach ON weight > p GROUP BY c_custkey""",
        "live_metrics": _sql(_METRIC_ROWS, "met"),
        "live_metrics_redelivered": _sql(
            "SELECT metric, key, value FROM met WHERE metric <> 'events_processed' OR key = 'orders'", "met",
        ),
        "live_metrics_stream": _sql(_METRIC_ROWS, "met"),
        "live_order_total": _sql("SELECT count(*) AS orders_total FROM ord", "ord"),
        "live_status_counts": _sql(
            "SELECT key AS status, CAST(value AS BIGINT) AS n FROM sums WHERE metric = 'orders_status'", "sums"
        ),
        "live_net_revenue": _sql("SELECT value AS revenue_net FROM sums WHERE metric = 'revenue_net'", "sums"),
        "live_orders_by_city": _sql("SELECT city, n FROM city ORDER BY n DESC, city", "city"),
        "live_events_processed": _sql(
            """SELECT CAST(sum(n) AS BIGINT) AS events_processed, make_timestamp(max(ts_ms) * 1000) AS updated_at
            FROM seen""",
            "seen",
        ),
        "dim_user_city": _sql("SELECT user_id, city FROM su WHERE NOT is_deleted", "su"),
        "dim_product_name": _sql("SELECT product_id, name FROM sp", "sp"),
        "asof_city": _sql(
            """SELECT CASE WHEN user_id % 50 = 9 AND (user_id + 1) * 160 + 8 <= (order_id + 1) * 16 THEN 'Unknown'
                    WHEN user_id % 10 = 4 AND (user_id + 1) * 160 + 8 <= (order_id + 1) * 16 THEN moved.n_name
                    ELSE home.n_name END AS city, count(*) AS n
            FROM ord JOIN customer ON c_custkey = user_id JOIN nation home ON home.n_nationkey = c_nationkey
            JOIN nation moved ON moved.n_nationkey = (c_nationkey + 1) % 25 GROUP BY 1""",
            "ord",
        ),
        "trending_minute": _sql(_MINUTES, "mi"),
        "trending_minute_stream": _sql(_MINUTES, "mi"),
        "trending_top": _sql("SELECT product_id, name, units FROM top", "top"),
        "trending_sliding": _sql(
            """SELECT minute, product_id, CAST(sum(units) OVER (PARTITION BY product_id ORDER BY minute
                RANGE BETWEEN INTERVAL 59 MINUTE PRECEDING AND CURRENT ROW) AS BIGINT) AS window_units FROM mi""",
            "mi",
        ),
        "live_summary": _sql(
            """SELECT metric AS section, CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, key) AS INTEGER) AS position,
                key AS label, value FROM met
            UNION ALL SELECT 'delivered_rate', 1, '', CAST(round_even(
                (SELECT CAST(value AS DOUBLE) FROM met WHERE key = 'DELIVERED')
                / (SELECT CAST(value AS DOUBLE) FROM met WHERE metric = 'orders_total') * 100, 0) AS DECIMAL(38,2))
            UNION ALL SELECT 'trending', CAST(row_number() OVER (ORDER BY units DESC, product_id) AS INTEGER), name,
                CAST(units AS DECIMAL(38,2)) FROM top
            UNION ALL SELECT 'updated_ms', 1, '', CAST(max(newest_ms) AS DECIMAL(38,2)) FROM met WHERE metric = 'events_processed'""",
            "met", "top",
        ),
        "live_vs_batch_drift": _sql(
            """SELECT metric, key, live, batch, CAST(live - batch AS DECIMAL(38,2)) AS drift FROM (
                SELECT coalesce(l.metric, b.metric) AS metric, coalesce(l.key, b.key) AS key,
                    CAST(coalesce(l.value, 0) AS DECIMAL(38,2)) AS live, CAST(coalesce(b.value, 0) AS DECIMAL(38,2)) AS batch
                FROM (SELECT metric, key, value FROM sums WHERE metric <> 'orders_total') l FULL JOIN (
                    SELECT 'orders_status' AS metric, status AS key, CAST(count(*) AS DECIMAL(38,2)) AS value
                    FROM co WHERE NOT is_deleted GROUP BY 2
                    UNION ALL SELECT 'revenue_net', '', CAST(sum(paid_amount) AS DECIMAL(38,2)) FROM co WHERE NOT is_deleted) b
                ON l.metric = b.metric AND l.key = b.key)""",
            "sums", "co",
        ),
        "stock_alerts": _sql(_ALERTS, "fall"),
        "stock_alerts_stream": _sql(_ALERTS, "fall"),
        "bronze_stream": _sql(
            """SELECT 'orders' AS table_name, op, count(*) AS n, max(lsn) AS max_lsn FROM ev GROUP BY 2
            UNION ALL SELECT 'users', 'r', count(*), 1 FROM customer
            UNION ALL SELECT 'users', CASE WHEN c_custkey % 10 = 4 THEN 'u' ELSE 'd' END, count(*), max((c_custkey + 1) * 160 + 8)
                FROM customer WHERE c_custkey % 10 = 4 OR c_custkey % 50 = 9 GROUP BY 2
            UNION ALL SELECT 'products', 'r', count(*), 1 FROM part
            UNION ALL SELECT 'products', 'u', count(*), max((p_partkey + 1) * 160 + 9) FROM part WHERE p_partkey % 40 = 7
            UNION ALL SELECT 'order_items', 'c', count(*), max(order_item_id * 2) FROM si
            UNION ALL SELECT 'order_items', 'd', count(*), max(order_item_id * 2 + 1) FROM si WHERE is_deleted""",
            "ev", "si",
        ),
        "dq_report": _report(None),
        "refresh_job": _report(None),
        "dq_not_null": _report("not_null"),
        "dq_accepted_values": _sql(
            """SELECT 'accepted_values:stg_orders.status' AS name, count(DISTINCT status) AS violations
            FROM fo WHERE status IN ('LOST', 'HELD')""",
            "fo",
        ),
        "dq_unique": _sql(
            """SELECT 'unique:bronze.orders.order_id' AS name, count(*) AS violations FROM ord
                WHERE n + CASE WHEN is_deleted THEN 1 ELSE 0 END > 1
            UNION ALL SELECT 'unique:bronze.users.user_id', count(*) FROM customer WHERE c_custkey % 10 = 4 OR c_custkey % 50 = 9
            UNION ALL SELECT 'unique:bronze.products.product_id', count(*) FROM part WHERE p_partkey % 40 = 7
            UNION ALL SELECT 'unique:bronze.order_items.order_item_id', count(*) FROM si WHERE is_deleted""",
            "ord", "si",
        ),
        "dq_relationships": _sql(
            """SELECT name, violations, CASE WHEN violations > 500 THEN 'error' WHEN violations > 0 THEN 'warn' ELSE 'pass' END AS verdict
            FROM (SELECT 'relationships:stg_order_items.order_id' AS name, count(*) AS violations
                FROM ln WHERE order_id % 97 = 13)""",
            "ln",
        ),
        "dq_category_non_negative": _sql(
            f"""SELECT * FROM (
                SELECT category, CAST(sum(q) AS BIGINT) AS total_quantity, CAST(sum(q * unit_price) AS DECIMAL(38,2)) AS total_revenue
                FROM (SELECT ci.category, ci.order_id, ci.unit_price, ci.is_deleted AS gone, CASE WHEN order_item_id % 97 = 14 THEN {WRONG_QUANTITY} ELSE quantity END AS q FROM ci)
                JOIN so USING (order_id)
                WHERE so.status IN {_REVENUE} AND NOT so.is_deleted AND NOT gone GROUP BY 1)
            WHERE total_quantity < 0 OR total_revenue < 0""",
            "ci", "so",
        ),
        "dq_daily_counts": _sql(
            """SELECT order_date, total_orders, cancelled_orders, unique_customers FROM daily
            WHERE cancelled_orders > total_orders OR unique_customers > total_orders""",
            "daily",
        ),
        "dq_daily_non_negative": _sql("SELECT order_date, total_revenue FROM fd WHERE total_revenue < 0", "fd"),
        # Both sides stacked and summed by day.
        "dq_revenue_reconciliation": _sql(
            """SELECT CASE WHEN mart IS NOT NULL THEN day END AS order_date, mart AS total_revenue, silver AS revenue,
                CAST(abs(mart - silver) AS DECIMAL(23,2)) AS diff
            FROM (SELECT day, CAST(sum(mart) AS DECIMAL(22,2)) AS mart, CAST(sum(silver) AS DECIMAL(22,2)) AS silver
                FROM (SELECT order_date AS day, total_revenue AS mart, NULL AS silver FROM fd
                    UNION ALL SELECT CAST(created_at AS DATE), NULL, paid_amount FROM co)
                GROUP BY day)
            WHERE abs(coalesce(mart, 0) - coalesce(silver, 0)) > 0.01""",
            "fd", "co",
        ),
        "guarded_sql": _sql(
            """SELECT city, count(*) AS total_orders, CAST(sum(paid_amount) AS DECIMAL(22,2)) AS spend
            FROM co WHERE NOT is_deleted GROUP BY city""",
            "co",
        ),
    }
