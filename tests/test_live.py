"""Live metrics, trending and alerts: the reference behaviours on small logs."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import change, make_log, order, ordered, rows
from tidemark.functions.envelope import drop_redelivered, envelope
from tidemark.plans import alerts, live
from tidemark.plans.core import order_flags


def metrics(spark, *values):
    sums = live.sum_deltas(live.order_deltas(live.order_changes(make_log(spark, "orders", values))))
    return {(r.metric, r.key): r.value for r in sums.collect() if r.value}


def revenue(found):
    return found.get((live.REVENUE, ""), Decimal(0))


def statuses(found):
    return {key: int(value) for (metric, key), value in found.items() if metric == live.STATUS}


def test_lifecycle_with_return_takes_revenue_back_once(spark):
    path = ["CREATED", "PAID", "PREPARING", "SHIPPED", "DELIVERED", "RETURNED", "REFUNDED"]
    values = [change("c", after=order(1, path[0]))]
    values += [change("u", before=order(1, a), after=order(1, b)) for a, b in zip(path, path[1:])]
    assert revenue(metrics(spark, *values[:2])) == Decimal("10.00")
    assert revenue(metrics(spark, *values[:5])) == Decimal("10.00")
    found = metrics(spark, *values)
    assert (revenue(found), statuses(found)) == (0, {"REFUNDED": 1})
    assert found[(live.TOTAL, "")] == 1


def test_snapshot_in_revenue_status_counts(spark):
    found = metrics(spark, change("r", after=order(1, "SHIPPED", "7.50")))
    assert (revenue(found), statuses(found)) == (Decimal("7.50"), {"SHIPPED": 1})


def test_update_without_before_image(spark):
    found = metrics(spark, change("u", after=order(1, "PAID")))
    assert (revenue(found), statuses(found)) == (Decimal("10.00"), {})


def test_amount_change_within_revenue_is_ignored(spark):
    found = metrics(
        spark, change("c", after=order(1, "PAID")), change("u", before=order(1, "PAID"), after=order(1, "PAID", "99.00"))
    )
    assert revenue(found) == Decimal("10.00")


def test_reversal_uses_the_new_amount_and_delete_the_old(spark):
    start = change("c", after=order(1, "PAID"))
    reversal = change("u", before=order(1, "PAID"), after=order(1, "REFUNDED", "4.00"))
    assert revenue(metrics(spark, start, reversal)) == Decimal("6.00")
    assert revenue(metrics(spark, start, change("d", before=order(1, "PAID", "3.00")))) == Decimal("7.00")


def test_delete_lowers_status_but_not_total(spark):
    found = metrics(spark, change("c", after=order(1)), change("d", before=order(1)))
    assert (statuses(found), found[(live.TOTAL, "")]) == ({}, 1)


def test_defaults_and_incomplete_changes(spark):
    found = metrics(
        spark,
        change("c", after=order(1, "")),
        change("c", after=order(2, None, amount=None)),
        change("c", after=order(3, "PAID", amount="?")),
        change("c"),
        change("c", after={}),
        change("d"),
        None,
        "no json",
    )
    assert statuses(found) == {"CREATED": 2, "PAID": 1}
    assert (found[(live.TOTAL, "")], revenue(found)) == (3, 0)
    assert found[(live.EVENTS, "orders")] == 6


def test_city_of_unknown_or_nameless_customers(spark):
    log = make_log(spark, "orders", [change("c", after=order(i, user=u)) for i, u in enumerate((1, 1, 2, 3, 4))])
    users = spark.createDataFrame(
        [(1, "Izmir", False), (2, "", False), (3, "Bursa", True)], "user_id bigint, city string, is_deleted boolean"
    )
    sums = live.sum_deltas(live.order_deltas(live.order_changes(log)))
    assert rows(live.by_city(sums, live.user_city(users)).select("city", "n")) == [("Izmir", 2), ("Unknown", 3)]


def test_live_equals_batch_when_amounts_stay(spark):
    log = make_log(
        spark,
        "orders",
        [
            change("c", after=order(1), lsn=1),
            change("u", before=order(1), after=order(1, "PAID"), lsn=2),
            change("c", after=order(2, amount="5.00"), lsn=3),
            change("u", before=order(2, amount="5.00"), after=order(2, "CANCELLED", "5.00"), lsn=4),
            change("d", before=order(2, "CANCELLED", "5.00"), lsn=5),
        ],
    )
    from tidemark.functions.envelope import envelope
    from tidemark.operators.state import stage

    sums = live.sum_deltas(live.order_deltas(live.order_changes(log)))
    drift = live.drift(sums, order_flags(stage(envelope(log, "order_id"), "orders")))
    assert {(r.metric, r.key): r.drift for r in drift.collect() if r.drift} == {}


def line(item, product, quantity):
    return {"order_item_id": item, "order_id": 1, "product_id": product, "quantity": quantity}


def minutes(spark, *values):
    return live.trending_minute(live.item_changes(make_log(spark, "order_items", values)))


def test_trending_counts_new_lines_per_minute(spark):
    found = minutes(
        spark,
        change("c", after=line(1, 5, 2), ts_ms=60_000),
        change("r", after=line(2, 5, 3), ts_ms=119_999),
        change("c", after=line(3, 5, 4), ts_ms=120_000),
        change("u", after=line(3, 5, 9), ts_ms=120_000),
        change("d", before=line(3, 5, 9), ts_ms=120_000),
        change("c", after=line(4, None, 1)),
        change("c", after=line(5, 5, None)),
    )
    assert rows(found.select(F.unix_timestamp("minute"), "product_id", "units")) == [(60, 5, 5), (120, 5, 4)]


def test_trending_window_is_anchored_on_the_newest_minute(spark):
    minute = 60_000
    found = minutes(
        spark,
        change("c", after=line(1, 1, 100), ts_ms=40 * minute),
        change("c", after=line(2, 2, 5), ts_ms=41 * minute),
        change("c", after=line(3, 3, 5), ts_ms=100 * minute),
        change("c", after=line(4, 4, 50), ts_ms=101 * minute),
    )
    anchor = spark.createDataFrame([(100 * 60,)], "s bigint").select(F.timestamp_seconds("s").alias("minute"))
    products = envelope(make_log(spark, "products", [change("r", after={"product_id": 2, "name": "Lamp"})]), "product_id")
    top = [tuple(r) for r in live.trending_top(found, anchor, products, window=60).collect()]
    assert top == [(2, "Lamp", 5), (3, "#3", 5)]


def stock(*levels):
    """Readings of one product; None is a delete."""
    return [
        change("d", before={"product_id": 1, "stock_qty": 0}) if q is None else change("u", after={"product_id": 1, "stock_qty": q})
        for q in levels
    ]


ALERT_CASES = [
    ((12, 9, 8, 10, 9, None, 5), [9, 9]),
    ((9,), [9]),
    ((10, 10), []),
    ((0, 0, 0), [0]),
    ((5, 20, 5, 20, 5), [5, 5, 5]),
]


@pytest.mark.parametrize("levels, expected", ALERT_CASES)
def test_alerts_fire_on_the_fall_and_rearm(spark, levels, expected):
    readings = alerts.stock_readings(make_log(spark, "inventory", stock(*levels)))
    assert [r.stock_qty for r in alerts.stock_alerts(readings).orderBy("alert_time").collect()] == expected


def test_alerts_need_product_and_quantity(spark):
    log = make_log(spark, "inventory", [change("u", after={"product_id": 1}), change("u", after={"stock_qty": 1}), None])
    assert alerts.stock_alerts(alerts.stock_readings(log)).count() == 0


def test_alerts_equal_brute_force(spark):
    chance = np.random.default_rng(3)
    data = [(int(p), int(q)) for p, q in zip(chance.integers(0, 5, 400), chance.integers(0, 25, 400))]
    values = [change("u", after={"product_id": p, "stock_qty": q}, ts_ms=i) for i, (p, q) in enumerate(data)]
    low, expected = set(), []
    for i, (p, q) in enumerate(data):
        if q >= 10:
            low.discard(p)
        elif p not in low:
            low.add(p)
            expected.append((p, q, i))
    found = alerts.stock_alerts(alerts.stock_readings(make_log(spark, "inventory", values)))
    assert rows(found.select("product_id", "stock_qty", F.unix_millis("alert_time"))) == ordered(expected)
