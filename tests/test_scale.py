"""Hot keys, long lists, lost commits: what must hold whatever the size."""

import pytest
from pyspark.sql import functions as F

from conftest import FOLDER, change, make_log, order, rows
from tidemark.functions.envelope import MONTH, envelope
from tidemark.lake import lake, write_bronze
from tidemark.operators.assign import weighted_assignment
from tidemark.operators.state import stage, staged
from tidemark.plans import analyses, core, incremental, marts, refresh
from tidemark.sources.changelog import numbered_lines

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50k",
}


@pytest.fixture
def small_partitions(spark):
    old = {name: spark.conf.get(name, None) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Staging tables in which one customer, order and product have 95 % of all rows."""
    root = str(tmp_path_factory.mktemp("staging"))
    n, hot = 400_000, F.col("id") % 20 != 0
    text = lambda kind: F.sha2(F.concat(F.lit(kind), F.col("id").cast("string")), 256)
    spark.range(2000).selectExpr("id AS user_id", "concat('u', id) AS full_name", "'X' AS city", "false AS is_deleted").write.parquet(f"{root}/users")
    spark.range(2000).selectExpr("id AS product_id", "concat('p', id) AS name", "concat('c', id % 7) AS category", "false AS is_deleted").write.parquet(f"{root}/products")
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), F.when(hot, 7).otherwise(F.col("id") % 2000).cast("bigint").alias("user_id"),
        F.lit("PAID").alias("status"), F.lit(1).cast("decimal(12,2)").alias("total_amount"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"), F.lit(False).alias("is_deleted"), text("o").alias("more"),
    )
    orders.write.parquet(f"{root}/orders")
    items = spark.range(n).select(
        F.col("id").alias("order_item_id"), F.when(hot, 7).otherwise(F.col("id") % n).cast("bigint").alias("order_id"),
        F.when(hot, 7).otherwise(F.col("id") % 2000).cast("bigint").alias("product_id"), F.lit(1).cast("bigint").alias("quantity"),
        (F.rand(3) * 1000).cast("decimal(10,2)").alias("unit_price"), F.lit(False).alias("is_deleted"),
    )
    items.write.parquet(f"{root}/items")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("users", "products", "orders", "items")}


PLANS = {
    "core_orders": lambda t: core.core_orders(t["orders"], t["users"]),
    "core_order_items": lambda t: core.core_order_items(t["items"], t["products"]),
    "mart_sales_by_category": lambda t: marts.sales_by_category(core.core_order_items(t["items"], t["products"]), t["orders"]),
    "order_header": lambda t: core.order_header(t["orders"], t["users"]),
    "order_detail": lambda t: core.order_lines(core.order_header(t["orders"], t["users"]), t["items"], t["products"]),
    "cancellations_by_city": lambda t: analyses.cancellations_by_city(core.core_orders(t["orders"], t["users"])),
    "best_category_month": lambda t: analyses.best_category_of_last_month(core.core_order_items(t["items"], t["products"]), t["orders"]),
}


@pytest.mark.parametrize("name", PLANS)
def test_joins_split_a_hot_key(spark, small_partitions, tables, name):
    result = PLANS[name](tables)
    grouped = name in ("mart_sales_by_category", "cancellations_by_city", "best_category_month")
    frame = result if grouped else result.agg(F.max(F.xxhash64(*result.columns)))
    frame.collect()
    assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def test_registered_plans_read_staging_tables(spark):
    from conftest import FOLDER
    from tidemark import registry

    for name in PLANS:
        text = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in text and "from_json" not in text


def test_long_weight_list_and_a_hot_point(spark):
    weights = spark.range(1, 20_001).selectExpr("concat('n', lpad(id, 5, '0')) AS name", "id % 50 AS w")
    listed = sorted(((r.w, r.name) for r in weights.collect() if r.w), key=lambda x: (-x[0], x[1]))
    bands, low = [], 0
    for weight, name in listed:
        bands.append((low, low + weight, name))
        low += weight
    points = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 17).alias("p"))
    found = weighted_assignment(points, weights, "name", "w", F.col("p")).collect()
    assert len(found) == 30_000
    import bisect

    lows = [b[0] for b in bands]
    for r in found:
        assert r.name == bands[bisect.bisect_right(lows, r.p % low) - 1][2]


def test_a_broken_increment_loses_nothing(spark, tmp_path, monkeypatch):
    day = 86_400_000
    first = [change("c", after=order(i), lsn=i, ts_ms=i * day) for i in range(1, 60)]
    later = [change("u", before=order(i), after=order(i, "PAID"), lsn=100 + i, ts_ms=(70 + i) * day) for i in range(1, 20)]
    write_bronze(envelope(make_log(spark, "orders", first + later), "order_id"), str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    path, mark = str(tmp_path / "state"), 65 * day
    before = envelope(make_log(spark, "orders", first), "order_id")
    incremental.write_state(before, "orders", path, shard_rows=100)
    want = rows(staged(incremental.read_state(spark, path), "orders"))

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as patch:  # after the data, before the pointer
        patch.setattr(incremental, "_publish", lost)
        with pytest.raises(RuntimeError):
            incremental.apply_changes(spark, bronze, "orders", path, mark)
    assert rows(staged(incremental.read_state(spark, path), "orders")) == want
    for _ in range(2):
        state = incremental.apply_changes(spark, bronze, "orders", path, mark)
        assert rows(staged(state, "orders")) == rows(stage(bronze, "orders"))


def test_cuts_by_time_read_the_months_they_need(spark):
    from conftest import FOLDER
    from tidemark import registry

    for name in ("stg_orders_asof", "cancelled_recent"):
        text = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(commit_month" in text


def test_histories_are_read_and_parsed_once(spark):
    from conftest import FOLDER
    from tidemark import registry

    for name in ("stock_alerts", "burn_rate", "order_history", "asof_city"):
        text = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in text  # what is scanned was parsed and landed before
    for name in ("live_order_total", "live_status_counts", "live_net_revenue"):
        assert "user_id" not in registry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]


def test_lines_are_numbered_where_they_lie(spark, small_partitions):
    """The start of each sort partition goes to the lines: they are not shuffled a second time for it."""
    plan = numbered_lines(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_replaced_table_is_written_compactly(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS compact")
    refresh.replace_table(spark, spark.range(3), "compact.t", str(tmp_path))
    files = [f.name for f in tmp_path.rglob("part-*")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_a_replaced_table_shows_its_new_columns(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swap LOCATION '{tmp_path}/swap'")
    refresh.replace_table(spark, spark.sql("SELECT 1 AS a"), "swap.t", str(tmp_path))
    refresh.replace_table(spark, spark.sql("SELECT 2 AS a, 'x' AS b"), "swap.t", str(tmp_path))
    assert rows(spark.table("swap.t")) == [(2, "x")]


def test_catalog_bronze_holds_what_is_landed(spark):
    from conftest import FOLDER
    from tidemark import registry

    registry.queries()["guarded_sql"](spark, FOLDER)
    at = lake(spark, FOLDER)
    for entity in ("orders", "users", "order_items"):
        table = spark.table(f"{at.prefix}bronze.{entity}")
        assert table.count() == at.bronze(entity).count() > 0 and "commit_month" not in table.columns


def _orders(spark, first, last, lsn=1):
    """Bronze with a row for each order of a range."""
    after = F.to_json(F.struct(F.col("id").alias("order_id"), F.lit(1).alias("user_id"), F.lit("PAID").alias("status")))
    return spark.range(first, last).select(
        F.lit("c").alias("op"), F.lit(lsn).cast("bigint").alias("lsn"), F.lit(1000 * lsn).cast("bigint").alias("ts_ms"),
        F.col("id").alias("kafka_offset"), F.lit(0).alias("kafka_partition"), F.col("id").alias("order_id"), after.alias("raw_payload"),
        F.lit("1970-01-01").cast("date").alias(MONTH),
    )


def _ids(df):
    return sorted(r.order_id for r in df.select("order_id").collect())


def test_building_a_state_twice_loses_no_rows(spark, tmp_path):
    path, bronze = str(tmp_path / "state"), _orders(spark, 0, 40)
    for _ in range(2):
        incremental.write_state(bronze, "orders", path, shard_rows=10)
    assert _ids(incremental.read_state(spark, path)) == list(range(40))
    more = bronze.unionByName(_orders(spark, 30, 50, lsn=2))
    state = incremental.apply_changes(spark, more, "orders", path, mark_ms=2000, shard_rows=10)
    assert _ids(state) == list(range(50))
    assert {r.lsn for r in state.where("order_id >= 30").collect()} == {2}


def test_a_rebuild_over_a_newer_state_takes_effect(spark, tmp_path):
    path = str(tmp_path / "state")
    incremental.write_state(_orders(spark, 0, 40), "orders", path, shard_rows=10)
    incremental.apply_changes(spark, _orders(spark, 40, 50, lsn=2), "orders", path, mark_ms=0, shard_rows=10)
    incremental.write_state(_orders(spark, 0, 4), "orders", path)
    assert _ids(incremental.read_state(spark, path)) == list(range(4))


def test_shards_split_as_the_state_grows(spark, tmp_path):
    path, most = str(tmp_path / "state"), 64
    incremental.write_state(_orders(spark, 0, 30), "orders", path, shard_rows=most)
    assert [r.n for r in incremental.newest(spark, path).collect()] == [30]
    for lsn, (first, last) in enumerate(((0, 300), (300, 3000), (2990, 3000)), 2):
        state = incremental.apply_changes(spark, _orders(spark, first, last, lsn), "orders", path, 1000 * lsn, shard_rows=most)
        assert _ids(state) == list(range(last))
    shards = incremental.newest(spark, path).collect()
    assert sum(s.n for s in shards) == 3000 and max(s.n for s in shards) <= 1.5 * most and len(shards) >= 3000 / most
    assert sum(2.0 ** -s.bits for s in shards) == 1.0
    # The last increment wrote the shards of ten orders and no others.
    assert 1 <= sum(s.source == 3 for s in shards) <= 20 < len(shards)


def test_logs_are_built_from_narrow_rows_in_tasks_of_few_records(spark, tmp_path, monkeypatch):
    from conftest import FOLDER
    from tidemark.sources import changelog
    from tidemark.sources.log import write_log

    monkeypatch.setattr(changelog, "FILE_RECORDS", 500)
    built = changelog.orders_log(spark, FOLDER)
    plan = built._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange rangepartitioning")
    assert "Generate explode" in plan[:exchange] and "Generate" not in plan[exchange:]
    write_log(built, str(tmp_path), ranged=True)
    files = spark.read.parquet(str(tmp_path)).groupBy(F.input_file_name(), "partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("*").alias("n")
    ).orderBy("partition", "low").collect()
    assert len(files) > 6 and max(r.n for r in files) < 2000
    assert all(a.partition != b.partition or a.high < b.low for a, b in zip(files, files[1:]))
