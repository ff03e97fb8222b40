"""Envelope, quarantine and latest state on hand-written logs."""

import random
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import change, make_log, order, rows
from tidemark.domain import CREATE_OPS
from tidemark.functions.envelope import decode, drop_redelivered, envelope, extract, image_key, incomplete, quarantine
from tidemark.plans.live import order_changes
from tidemark.operators.state import entity_state, stage, staged, state_as_of, upsert


def orders_bronze(spark, *values):
    return envelope(make_log(spark, "orders", values), "order_id")


def staged_rows(bronze):
    return {r.order_id: r for r in stage(bronze, "orders").collect()}


def test_delete_takes_key_and_payload_from_before(spark):
    [row] = orders_bronze(spark, change("d", before=order(7, "CANCELLED"), lsn=5)).collect()
    assert (row.op, row.lsn, row.order_id) == ("d", 5, 7)
    assert '"status":"CANCELLED"' in row.raw_payload.replace(" ", "")


def test_only_known_operations_are_landed(spark):
    values = [change(op, after=order(i)) for i, op in enumerate(("c", "u", "r", "t", "x"))]
    values += [change("d", before=order(9)), None, "no json", '{"payload":null}', '{"payload":{}}', "[1]"]
    assert sorted(r.op for r in orders_bronze(spark, *values).collect()) == ["c", "d", "r", "u"]


def test_quarantine_names_the_reason(spark):
    values = [
        change("c", after=order(1)), None, "{broken", '{"payload":null}', '{"payload":{"after":{}}}',
        change("t", after=order(1)), change("c", after={"status": "PAID"}),
    ]
    found = quarantine(make_log(spark, "orders", values), "order_id")
    assert rows(found.select("kafka_offset", "reason")) == [
        (1, "tombstone"), (2, "bad json"), (3, "no payload"), (4, "no op"), (5, "unknown op"), (6, "no key"),
    ]


def test_a_leading_key_is_read_like_any_other(spark):
    """The key is read off the front of a new image that came as an object; wherever that does not
    apply, as the JSON function reads it."""
    images = [
        {"order_id": 7, "x": 1}, {"x": 1, "order_id": 7}, {"order_id": "7"}, {"order_id": 7.5}, {"order_id": -7},
        {"order_id": 10**18}, {"order_id": 10**19}, {"order_id": None}, {"order_id": 7}, {"order_id": {"order_id": 7}},
        {"order_ids": 7}, {}, '{"order_id":7,"x":1}', '{"order_id":7,"x', "order_id", [{"order_id": 7}],
    ]
    values = [change("u", {"order_id": 9}, image) for image in images] + [change("d", {"order_id": 9})]
    values += [value.replace(": ", ":").replace(", ", ",") for value in values]
    log = decode(make_log(spark, "orders", values))
    plain = F.coalesce(F.get_json_object("after", "$.order_id"), F.get_json_object("before", "$.order_id")).try_cast("bigint")
    found = log.select("kafka_offset", image_key("order_id").alias("key"), plain.alias("plain")).collect()
    assert len(found) == len(values) and all(r.key == r.plain for r in found)
    first = log.where("kafka_offset >= 17").select(F.regexp_extract("after", '^\\{"order_id":([0-9]+)', 1).alias("k"))
    assert first.where("k = '7'").count() >= 2
    plan = log.select(image_key("order_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract") < plan.index("get_json_object")


def test_unparsable_fields_become_null(spark):
    bad = order(1, amount="12,5", created="yesterday")
    [row] = stage(orders_bronze(spark, change("c", after=bad)), "orders").collect()
    assert (row.total_amount, row.created_at, row.status) == (None, None, "CREATED")


def test_new_source_column_can_be_read_later(spark):
    bronze = orders_bronze(spark, change("c", after=order(1, extra={"coupon": "X1"}, tip=3)))
    read = extract(bronze, {"coupon": ("$.extra.coupon", "string"), "tip": ("$.tip", "int")})
    assert rows(read.select("order_id", "coupon", "tip")) == [(1, "X1", 3)]


def test_snapshot_rows_with_one_lsn_are_ranked_by_offset(spark):
    bronze = orders_bronze(spark, change("r", after=order(1, "CREATED")), change("r", after=order(1, "PAID")))
    assert staged_rows(bronze)[1].status == "PAID"


def test_delete_then_recreate_is_live_again(spark):
    bronze = orders_bronze(
        spark,
        change("c", after=order(1, "PAID"), lsn=30),
        change("d", before=order(1), lsn=20),
        change("c", after=order(1), lsn=10),
    )
    assert (staged_rows(bronze)[1].status, staged_rows(bronze)[1].is_deleted) == ("PAID", False)


def test_deleted_row_is_kept_with_its_last_values(spark):
    bronze = orders_bronze(spark, change("c", after=order(1), lsn=1), change("d", before=order(1, "REFUNDED"), lsn=2))
    row = staged_rows(bronze)[1]
    assert (row.is_deleted, row.status, row.total_amount) == (True, "REFUNDED", Decimal("10.00"))


def test_unknown_lsn_ranks_last(spark):
    bronze = orders_bronze(spark, change("c", after=order(1, "PAID"), lsn=1), change("u", after=order(1, "CREATED"), lsn=None))
    assert staged_rows(bronze)[1].status == "PAID"


def test_days_are_utc_days(spark):
    bronze = orders_bronze(
        spark,
        change("c", after=order(1, created="2024-01-01T23:59:59Z")),
        change("c", after=order(2, created="2024-01-02T00:30:00+02:00")),
        change("c", after=order(3, created="2024-01-02T00:00:00Z")),
    )
    days = stage(bronze, "orders").select("order_id", F.to_date("created_at").cast("string"))
    assert rows(days) == [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02")]


def history():
    """Changes of a few orders, in log order."""
    step = st.tuples(st.integers(1, 4), st.sampled_from(["c", "u", "d"]), st.sampled_from(["CREATED", "PAID", "SHIPPED"]))
    return st.lists(step, min_size=1, max_size=12)


def as_values(steps):
    return [
        change(op, before=order(key, status) if op != "c" else None, after=order(key, status) if op != "d" else None, lsn=i + 1, ts_ms=1000 * (i + 1))
        for i, (key, op, status) in enumerate(steps)
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history(), st.randoms(use_true_random=False))
def test_state_does_not_depend_on_arrival(spark, steps, chance: random.Random):
    values = as_values(steps)
    expected = {}
    for key, op, status in steps:
        expected[key] = (status, op == "d")
    log = make_log(spark, "orders", values)
    shuffled = log.unionByName(log).orderBy(F.rand(chance.randrange(1000)))
    state = stage(envelope(shuffled, "order_id"), "orders")
    assert {r.order_id: (r.status, r.is_deleted) for r in state.collect()} == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history(), st.integers(0, 12))
def test_upsert_equals_full_rebuild(spark, steps, cut):
    values = as_values(steps)
    bronze = envelope(make_log(spark, "orders", values), "order_id")
    old = entity_state(bronze.where(F.col("kafka_offset") < cut), "orders")
    # The overlap by one change must not matter.
    new = bronze.where(F.col("kafka_offset") >= cut - 1)
    assert rows(staged(upsert(old, new, "orders"), "orders")) == rows(stage(bronze, "orders"))


def test_past_state_cuts_before_ranking(spark):
    bronze = orders_bronze(
        spark,
        change("c", after=order(1), lsn=1, ts_ms=1000),
        change("u", after=order(1, "PAID"), lsn=2, ts_ms=2000),
        change("c", after=order(2), lsn=3, ts_ms=3000),
    )
    assert [(r.order_id, r.status) for r in state_as_of(bronze, "orders", 1500).collect()] == [(1, "CREATED")]
    assert [(r.order_id, r.status) for r in state_as_of(bronze, "orders", 2000).collect()] == [(1, "PAID")]


def test_redelivered_records_count_once(spark):
    value = change("c", after=order(1))
    again = value.replace('"ts_ms": 1000}}', '"ts_ms": 9000}}')  # a new send time, the same commit
    other = change("c", after=order(1), lsn=2)
    log = make_log(spark, "orders", [value, again, other, value]).withColumn("key", F.lit("1"))
    assert again != value
    found = drop_redelivered(order_changes(log)).orderBy("lsn").collect()
    assert [(r.kafka_offset, r.lsn) for r in found] == [(0, 1), (2, 2)]


def test_lines_and_readings_without_their_fields_are_reported(spark):
    line = {"order_item_id": 1, "product_id": 2, "quantity": 3}
    values = [
        change("c", after=line),
        change("c", after={**line, "quantity": None}),
        change("c", after={"quantity": 3}),
        change("c", after=line, ts_ms=None),
        change("d", before=line),
    ]
    found = incomplete(make_log(spark, "order_items", values), "product_id", "quantity", ops=CREATE_OPS)
    assert [(r.kafka_offset, r.reason) for r in found.orderBy("kafka_offset").collect()] == [
        (1, "no quantity"),
        (2, "no product_id"),
        (3, "no time"),
    ]
