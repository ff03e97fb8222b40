"""Marts kept up by differences against full refreshes."""

import time

from pyspark.sql import functions as F

from conftest import change, make_log, order, rows
from tidemark.functions.envelope import between, envelope
from tidemark.operators.state import stage
from tidemark.plans import core, incremental, marts, upkeep
from tidemark.session import CLEANUP


def bronze_of(spark, topic, key, values):
    return envelope(make_log(spark, topic, values), key)


def orders_bronze(spark):
    made = [change("c", after=order(i, "CREATED", "10.00", i % 4, f"2024-0{1 + i % 5}-03T00:00:00Z"), lsn=i, ts_ms=i) for i in range(1, 21)]
    made.append(change("c", after=order(21, "PAID", "1.00", None, None), lsn=21, ts_ms=21))
    made.append(change("u", after=order(3, "PAID", "12.00", 3, "2024-04-03T00:00:00Z"), lsn=31, ts_ms=31))
    made.append(change("u", after=order(8, "CANCELLED", "10.00", 0, "2024-04-03T00:00:00Z"), lsn=32, ts_ms=32))
    made.append(change("d", before=order(4, "CREATED"), lsn=33, ts_ms=33))
    made.append(change("u", after=order(5, "CREATED", "10.00", 2, "2024-02-03T00:00:00Z"), lsn=34, ts_ms=34))
    made.append(change("d", before=order(21, "PAID", "1.00", None, None), lsn=41, ts_ms=41))
    made.append(change("c", after=order(22, "SHIPPED", "7.00", 9, "2024-04-09T00:00:00Z"), lsn=42, ts_ms=42))
    return bronze_of(spark, "orders", "order_id", made)


def test_daily_mart_equals_a_full_refresh_after_each_step(spark, tmp_path):
    bronze, state, path = orders_bronze(spark).cache(), str(tmp_path / "state"), str(tmp_path / "mart")
    incremental.write_state(between(bronze, last_ms=10), "orders", state, shard_rows=4)
    before = 0
    for until in (10, 30, 33, 40, 50):
        if until > 10:
            incremental.apply_changes(spark, between(bronze, last_ms=until), "orders", state, before, shard_rows=4)
        got = upkeep.refresh_daily(spark, state, path)
        full = marts.daily_revenue(core.order_flags(stage(between(bronze, last_ms=until), "orders")))
        assert got.dtypes == full.dtypes and rows(got) == rows(full)
        before = until
    months = spark.read.parquet(f"{path}/pointers").where("version = 4")
    # The last step: the order without a day went, one of April came; the other months lie where they were.
    assert {str(r.month) for r in months.where("source = 4").collect()} == {"0001-01-01", "2024-04-01"}
    assert months.where("source < 4").count() == 4
    versions = incremental.last_version(spark, path)
    assert rows(upkeep.refresh_daily(spark, state, path)) == rows(full) and incremental.last_version(spark, path) == versions


def test_difference_reads_only_what_changed(spark, tmp_path):
    bronze, state = orders_bronze(spark), str(tmp_path / "state")
    incremental.write_state(between(bronze, last_ms=21), "orders", state, shard_rows=1)
    incremental.apply_changes(spark, between(bronze, last_ms=31), "orders", state, 31, shard_rows=1)
    found = incremental.difference(spark, state, 0, 1)
    assert rows(found.select("sign", "order_id", "status")) == [(-1, 3, "CREATED"), (1, 3, "PAID")]
    assert found.inputFiles() and rows(incremental.difference(spark, state, 1, 1)) == []
    assert incremental.read_state(spark, state, 0).where("order_id = 3").first().status == "CREATED"


def test_category_mart_equals_a_full_refresh_after_each_step(spark, tmp_path):
    def product(id, category):
        return {"product_id": id, "name": f"p{id}", "category": category, "price": "1.00"}

    def line(id, order_id, product_id, quantity=1):
        return {"order_item_id": id, "order_id": order_id, "product_id": product_id, "quantity": quantity, "unit_price": "2.50"}

    products = [change("c", after=product(i, f"c{i % 3}"), lsn=i, ts_ms=1) for i in range(1, 7)]
    products.append(change("u", after=product(2, "new"), lsn=20, ts_ms=20))
    orders = [change("c", after=order(i, "PAID" if i % 2 else "CREATED"), lsn=i, ts_ms=1) for i in range(1, 9)]
    orders.append(change("u", after=order(2, "PAID"), lsn=20, ts_ms=20))  # begins to sell
    orders.append(change("u", after=order(3, "CANCELLED"), lsn=30, ts_ms=30))
    orders.append(change("d", before=order(5, "PAID"), lsn=31, ts_ms=30))
    orders.append(change("u", after=order(7, "SHIPPED"), lsn=32, ts_ms=30))  # sells as before
    items = [change("c", after=line(i, 1 + i % 8, 1 + i % 6, i), lsn=i, ts_ms=1) for i in range(1, 25)]
    items.append(change("u", after=line(1, 1, 4, 9), lsn=30, ts_ms=30))  # other order, product and quantity
    items.append(change("d", before=line(6, 7, 1, 6), lsn=31, ts_ms=40))
    items.append(change("c", after=line(25, 99, 1), lsn=32, ts_ms=40))  # its order never comes
    logs = {"orders": orders, "order_items": items, "products": products}
    keys = {"orders": "order_id", "order_items": "order_item_id", "products": "product_id"}
    bronze = {name: bronze_of(spark, name, keys[name], values).cache() for name, values in logs.items()}
    states = {name: str(tmp_path / name) for name in logs}
    path = str(tmp_path / "mart")
    for name, table in bronze.items():
        incremental.write_state(between(table, last_ms=10), name, states[name], shard_rows=4)
    for until in (10, 20, 30, 40):
        for name, table in bronze.items():
            if until > 10:
                incremental.apply_changes(spark, between(table, last_ms=until), name, states[name], until, shard_rows=4)
        got = upkeep.refresh_category(spark, *states.values(), path)
        now = {name: stage(between(table, last_ms=until), name) for name, table in bronze.items()}
        full = marts.sales_by_category(core.core_order_items(now["order_items"], now["products"]), now["orders"])
        assert got.dtypes == full.dtypes and rows(got) == rows(full)
    assert rows(upkeep.refresh_category(spark, *states.values(), path)) == rows(full)
    assert spark.read.parquet(f"{path}/pointers").agg(F.max("version")).first()[0] == 3


def test_difference_of_increments_is_what_they_marked(spark, tmp_path):
    bronze, state = orders_bronze(spark).cache(), str(tmp_path / "state")
    incremental.write_state(between(bronze, last_ms=10), "orders", state, shard_rows=4)
    for since, until in ((0, 31), (31, 33), (33, 33), (33, 50)):  # the third brings nothing new
        incremental.apply_changes(spark, between(bronze, last_ms=until), "orders", state, since, shard_rows=4)
    data = spark.read.parquet(f"{state}/data")
    assert data.where("version = 3 and _mark is not null").isEmpty()
    assert not data.where("version = 2 and _mark = -1").isEmpty()

    def compared(before, after):
        old, new = (incremental.read_state(spark, state, v) for v in (before, after))
        came, went = new.exceptAll(old).selectExpr("*", "1L as sign"), old.exceptAll(new).selectExpr("*", "-1L as sign")
        return rows(came.unionByName(went))

    last = incremental.last_version(spark, state)
    for before, after in ((-1, 0), (0, 1), (1, 2), (2, 3), (1, last), (0, last), (last, last)):
        found = incremental.difference(spark, state, before, after)
        if before >= 0:
            assert rows(found) == compared(before, after)
            assert after != before + 1 or "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        else:
            assert rows(found.drop("sign")) == rows(incremental.read_state(spark, state, after))
    incremental.write_state(between(bronze, last_ms=33), "orders", state, shard_rows=4)  # a full build marks nothing
    for before in (0, last):
        assert rows(incremental.difference(spark, state, before, last + 1)) == compared(before, last + 1)


def test_a_change_at_the_position_of_the_state_is_not_new(spark, tmp_path):
    state = str(tmp_path / "state")
    bronze = bronze_of(spark, "orders", "order_id", [change("c", after=order(i, "PAID"), lsn=i, ts_ms=i) for i in range(1, 9)])
    incremental.write_state(bronze, "orders", state, shard_rows=4)
    incremental.apply_changes(spark, bronze, "orders", state, 5, shard_rows=4)
    assert rows(incremental.difference(spark, state, 0, 1)) == []
    assert incremental.read_state(spark, state).count() == sum(s.n for s in incremental.newest(spark, state).collect()) == 8


def test_landed_tables_leave_no_shuffle_files(spark):
    from tidemark.operators.scans import landed

    def shuffled():
        return {str(b) for b in _blocks(spark) if str(b).startswith("shuffle_")}

    before = shuffled()
    kept = landed(spark.range(1000).repartition(3, "id"))
    deadline = time.time() + 20
    while (left := shuffled() - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left and kept.count() == 1000
    assert spark.conf.get(CLEANUP, None) in (None, "false")


def _blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return [blocks.apply(i) for i in range(blocks.length())]
