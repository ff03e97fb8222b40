"""One cut over all tables."""

import pytest

from conftest import change, make_log, order, rows
from tidemark.functions.envelope import envelope
from tidemark.plans import cut


@pytest.fixture(scope="module")
def bronze(spark):
    def line(id, order_id):
        return {"order_item_id": id, "order_id": order_id, "product_id": 1, "quantity": 1, "unit_price": "1.00"}

    def put(topic, key, *partitions):
        logs = [make_log(spark, topic, values, partition=i) for i, values in enumerate(partitions)]
        table = envelope(logs[0], key)
        for log in logs[1:]:
            table = table.unionByName(envelope(log, key))
        return table

    at = lambda op, ms, row: change(op, after=row, lsn=ms, ts_ms=ms)
    return {
        # The second partition of the orders has come to 50 only.
        "orders": put(
            "orders", "order_id",
            [at("c", 10, order(1)), at("u", 60, order(1, "PAID")), at("c", 90, order(3))],
            [at("c", 20, order(2)), at("u", 50, order(2, "PAID"))],
        ),
        "users": put("users", "user_id", [at("c", 1, {"user_id": 1, "city": "A"}), at("u", 70, {"user_id": 1, "city": "B"})]),
        "products": put("products", "product_id", [at("c", 1, {"product_id": 1}), at("u", 80, {"product_id": 1})]),
        "order_items": put("order_items", "order_item_id", [at("c", 30, line(1, 1)), at("c", 40, line(2, 3)), at("c", 95, line(3, 3))]),
    }


def test_all_tables_are_cut_where_the_last_partition_stands(bronze):
    assert dict(rows(cut.reached(bronze))) == {"orders": 50, "users": 70, "products": 80, "order_items": 95}
    assert cut.cut_time(bronze) == 50 and cut.cut_time(bronze, 35) == 35 and cut.cut_time(bronze, 70) == 50
    tables = cut.consistent_cut(bronze)
    assert rows(tables["orders"].select("order_id", "status")) == [(1, "CREATED"), (2, "PAID")]
    assert rows(tables["users"].select("city")) == [("A",)]
    assert rows(tables["order_items"].select("order_item_id", "is_waiting")) == [(1, False), (2, True)]


@pytest.mark.parametrize("wanted", [0, 10, 29, 30, 45, 50, 100])
def test_no_line_is_without_its_order_at_any_time(bronze, wanted):
    tables = cut.consistent_cut(bronze, wanted)
    lines = tables["order_items"].where("not is_waiting")
    assert lines.join(tables["orders"], "order_id", "left_anti").count() == 0


def test_a_log_without_rows_leaves_no_common_time(bronze):
    tables = bronze | {"users": bronze["users"].limit(0)}
    assert cut.cut_time(tables) is None
    assert all(row[1:] == (0, 0, 0) for row in rows(cut.cut_counts(tables)))
