"""Scans over keys of any size, weighted assignment, numbering, checks."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FOLDER, ordered, rows
from tidemark.domain import CITY_WEIGHTS, STATUSES
from tidemark.operators import quality
from tidemark.operators.assign import bands, weighted_assignment
from tidemark.operators.quality import Check
from tidemark.operators.scans import carry_forward, previous, running_sum
from tidemark.plans import checks
from tidemark.plans.dictionary import data_dictionary
from tidemark.sources.changelog import numbered_lines


@pytest.fixture(scope="module")
def history(spark):
    """One key with a third of the rows and some small ones; values with gaps."""
    chance = np.random.default_rng(1)
    keys = [0 if i % 3 == 0 else int(chance.integers(1, 40)) for i in range(900)]
    values = [None if chance.random() < 0.3 else int(chance.integers(0, 50)) for _ in keys]
    data = [(k, i * 3, v) for i, (k, v) in enumerate(zip(keys, values))]
    return data, spark.createDataFrame(data, "k bigint, pos bigint, v bigint")


@pytest.mark.parametrize("bits", [2, 6, 20])
def test_scans_equal_brute_force(history, bits):
    data, df = history
    total, last, known, expected = {}, {}, {}, []
    for k, pos, v in data:
        total[k] = total.get(k, 0) + (v or 0)
        known[k] = v if v is not None else known.get(k)
        expected.append((k, pos, total[k], last.get(k), known[k]))
        last[k] = v
    found = running_sum(df, "k", ["pos"], "v", "total", bits)
    found = previous(found, "k", ["pos"], "v", "before", bits)
    found = carry_forward(found, "k", ["pos"], "v", "known", bits)
    assert rows(found.select("k", "pos", "total", "before", "known")) == ordered(expected)


def test_bands_and_assignment(spark):
    weights = spark.createDataFrame(list(CITY_WEIGHTS), "city string, pop bigint")
    cut = {r.city: (r.lo, r.hi) for r in bands(weights, "city", "pop").collect()}
    assert cut["Istanbul"] == (0, 15907) and max(hi for _, hi in cut.values()) == 44483
    points = spark.range(0, 44483 * 2, 7)
    found = weighted_assignment(points, weights, "city", "pop", F.col("id"))
    for row in found.collect():
        lo, hi = cut[row.city]
        assert lo <= row.id % 44483 < hi
    assert found.count() == points.count()


def test_line_numbers_are_the_places_in_the_table(spark):
    lines = numbered_lines(spark, FOLDER)
    ids = lines.agg(F.min("order_item_id"), F.max("order_item_id"), F.count_distinct("order_item_id")).first()
    assert tuple(ids) == (1, 6000, 6000)


def test_column_checks_count_rows_and_values(spark):
    df = spark.createDataFrame([(1, "A"), (None, "B"), (None, "B"), (2, "C"), (3, None)], "id int, s string")
    found = quality.column_checks(
        df, [Check("t", "not_null", "id"), Check("t", "not_null", "s"), Check("t", "accepted_values", "s", values=("A",))]
    )
    assert rows(found) == [("accepted_values:t.s", 2), ("not_null:t.id", 2), ("not_null:t.s", 1)]


def test_unique_and_relationships(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,), (None,), (None,)], "id int")
    parent = spark.createDataFrame([(1,), (3,)], "pid int")
    assert quality.unique(df, Check("t", "unique", "id")).first().violations == 2
    check = Check("t", "relationships", "id", parent="p", parent_column="pid")
    assert quality.relationships(df, parent, check).first().violations == 2


@pytest.mark.parametrize("n, expected", [(0, "pass"), (1, "warn"), (500, "warn"), (501, "error")])
def test_severity(spark, n, expected):
    verdict = spark.range(1).select(quality.severity(F.lit(n), F.lit(0), F.lit(500)).alias("v"))
    assert verdict.first().v == expected


def test_declared_checks():
    kinds = [c.kind for c in checks.CHECKS]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 50, "unique": 8, "accepted_values": 7, "relationships": 5, "assertion": 4,
    }
    assert len({c.name for c in checks.CHECKS}) == 74


def core(spark, *data):
    schema = "order_id bigint, user_id bigint, status string, created_at timestamp, paid_amount decimal(12,2), is_cancelled int, is_deleted boolean"
    from datetime import datetime

    return spark.createDataFrame(
        [(i, 1, s, datetime(2024, 1, d), Decimal(a), 0, deleted) for i, (s, d, a, deleted) in enumerate(data)], schema
    )


def test_reconciliation_sees_deleted_revenue(spark):
    from tidemark.plans.marts import daily_revenue

    orders = core(spark, ("PAID", 1, "10.00", False), ("PAID", 1, "5.00", True), ("PAID", 2, "1.00", False))
    mart = daily_revenue(orders)
    [gap] = checks.revenue_reconciliation(mart, orders).collect()
    assert (gap.total_revenue, gap.revenue, gap["diff"]) == (Decimal("10.00"), Decimal("15.00"), Decimal("5.00"))
    assert checks.revenue_reconciliation(mart, orders, only_active=True).count() == 0


def test_assertions_find_violators(spark):
    daily = spark.createDataFrame(
        [("a", 1, Decimal("-1"), 0, 1), ("b", 1, Decimal(1), 2, 1), ("c", 1, Decimal(1), 0, 3), ("d", 2, Decimal(0), 2, 2)],
        "order_date string, total_orders int, total_revenue decimal(22,2), cancelled_orders int, unique_customers int",
    )
    assert [r.order_date for r in checks.daily_non_negative(daily).collect()] == ["a"]
    assert sorted(r.order_date for r in checks.daily_counts(daily).collect()) == ["b", "c"]
    category = spark.createDataFrame([("x", -1, 5), ("y", 1, -5), ("z", 0, 0)], "category string, total_quantity int, total_revenue int")
    assert sorted(r.category for r in checks.category_non_negative(category).collect()) == ["x", "y"]


def test_null_category_is_a_group(spark):
    from tidemark.plans.marts import sales_by_category

    items = spark.createDataFrame(
        [(1, 1, None, 2, Decimal(4), False), (2, 1, "A", 1, Decimal(3), False), (3, 1, "A", 1, Decimal(3), True)],
        "order_item_id int, order_id bigint, category string, quantity bigint, line_total decimal(31,2), is_deleted boolean",
    )
    orders = spark.createDataFrame([(1, "PAID", False)], "order_id bigint, status string, is_deleted boolean")
    found = {r.category: (r.total_orders, r.total_quantity) for r in sales_by_category(items, orders).collect()}
    assert found == {None: (1, 2), "A": (1, 1)}


def test_dictionary_covers_every_table_once(spark):
    df = data_dictionary(spark)
    assert df.count() == df.select("table_name", "column_name").distinct().count() == 87
    assert df.where("description is null or description = ''").count() == 0
    assert STATUSES[0] == "CREATED"


def test_copies_of_a_change_are_listed_once(spark):
    from conftest import change, make_log, order
    from tidemark.functions.envelope import envelope
    from tidemark.plans.analyses import order_history

    created, paid = change("c", after=order(1), lsn=1), change("u", before=order(1), after=order(1, "PAID"), lsn=2)
    bronze = envelope(make_log(spark, "orders", [created, paid, created, paid, paid]), "order_id")
    found = order_history(bronze).select("lsn", "old_status", "new_status", "is_transition")
    assert rows(found) == [(1, None, "CREATED", True), (2, "CREATED", "PAID", True)]


def test_city_at_the_time_of_the_order(spark):
    from tidemark.plans.analyses import orders_by_city_then

    orders = spark.createDataFrame([(1, 5), (1, 5), (1, 10), (1, 20), (2, 7)], "user_id bigint, lsn bigint")
    versions = spark.createDataFrame(
        [(1, 6, "Izmir"), (1, 20, "Bursa"), (2, 8, "Konya")], "user_id bigint, lsn bigint, city string"
    )
    assert rows(orders_by_city_then(orders, versions)) == [("Bursa", 1), ("Izmir", 1), ("Unknown", 3)]


def test_key_checks_share_a_grouping_and_equal_the_single_checks(spark):
    tables = {
        "p": spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint"),
        "c": spark.createDataFrame([(1,), (3,), (3,), (None,), (2,)], "id bigint"),
        "d": spark.createDataFrame([("a",), ("a",)], "day string"),
    }
    checks = [
        Check("p", "unique", "id"),
        Check("c", "unique", "id"),
        Check("c", "relationships", "id", parent="p", parent_column="id"),
        Check("d", "unique", "day"),
    ]
    found = quality.key_checks(tables, checks)
    assert len(found) == 2
    got = {r.name: r.violations for df in found for r in df.collect()}
    single = [quality.unique(tables[c.table], c) for c in checks if c.kind == "unique"]
    single.append(quality.relationships(tables["c"], tables["p"], checks[2]))
    assert got == {r.name: r.violations for df in single for r in df.collect()}
    assert list(got.values()) == [1, 1, 2, 1]
