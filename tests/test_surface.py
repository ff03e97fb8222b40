"""Guarded SQL, catalog listing, and the refresh job."""

import pytest

from conftest import change, make_log, order
from tidemark.domain import KEYS
from tidemark.functions.envelope import envelope
from tidemark.plans import surface
from tidemark.plans.dictionary import descriptions
from tidemark.plans.refresh import refresh

USER = {"user_id": 1, "full_name": "Ada", "city": "Izmir", "created_at": "2024-01-01T00:00:00Z"}
PRODUCT = {"product_id": 1, "name": "Lamp", "category": "Home", "price": "5.00"}
ITEM = {"order_item_id": 1, "order_id": 1, "product_id": 1, "quantity": 2, "unit_price": "5.00"}


def bronze(spark, orders):
    values = {
        "orders": orders,
        "users": [change("r", after=USER)],
        "products": [change("r", after=PRODUCT)],
        "order_items": [change("c", after=ITEM)],
    }
    return {entity: envelope(make_log(spark, entity, values[entity]), key) for entity, key in KEYS.items()}


@pytest.mark.parametrize("text", ["select 1;", " SELECT 1 AS a ;; ", "with x as (select 1) select * from x", "show databases", "describe function abs", "desc function abs"])
def test_reads_are_accepted(spark, text):
    assert surface.safe_sql(spark, text).columns


@pytest.mark.parametrize("text", ["drop table t", "select 'delete'", "(select 1)", "-- note\nselect 1", "insert into t select 1", "explain select 1", "", "select 1; call f()"])
def test_others_are_rejected(spark, text):
    with pytest.raises(surface.Rejected):
        surface.safe_sql(spark, text)
    assert surface.run_query(spark, text).startswith("not run: a query ")


def test_text_result_is_capped(spark):
    assert surface.run_query(spark, "select null as a, 1 as b") == "a\tb\n\\N\t1"
    text = surface.run_query(spark, "select id from range(250)").splitlines()
    assert (len(text), text[-1]) == (102, "[first 100 rows]")
    assert surface.run_query(spark, "select nothing from nowhere").startswith("not run: [TABLE_OR_VIEW_NOT_FOUND]")


def test_refresh_builds_tables_and_catalog(spark, tmp_path):
    paid = [change("c", after=order(1), lsn=1), change("u", before=order(1), after=order(1, "PAID"), lsn=2)]
    tables = refresh(spark, bronze(spark, paid), str(tmp_path), prefix="one_")
    assert tables["dq_report"].where("verdict <> 'pass'").count() == 0
    assert spark.table("one_gold.mart_daily_revenue").first().total_revenue == 10
    listed = {(r.namespace, r.table_name) for r in surface.catalog_tables(spark).collect()}
    for name in descriptions():
        layer, table = name.split(".")
        assert (f"one_{layer}", table) in listed
        columns = {r.col_name for r in surface.catalog_columns(spark, f"one_{name}").collect()}
        assert columns == set(descriptions()[name])
    assert "one_gold\tmart_daily_revenue" in surface.list_tables(spark)
    assert "total_revenue\tdecimal(22,2)" in surface.describe_table(spark, "one_gold.mart_daily_revenue")
    assert surface.describe_table(spark, "a; drop table b") == "not described: 'a; drop table b' names no table"

    # A later run replaces the rows; leaving out a layer reads the earlier table.
    refunded = [*paid, change("u", before=order(1, "PAID"), after=order(1, "REFUNDED"), lsn=3)]
    refresh(spark, bronze(spark, refunded), str(tmp_path), layers=("staging", "silver"), prefix="one_")
    assert spark.table("one_silver.core_orders").first().is_refunded == 1
    assert spark.table("one_gold.mart_daily_revenue").first().total_revenue == 10
    refresh(spark, bronze(spark, refunded), str(tmp_path), prefix="one_")
    assert spark.table("one_gold.mart_daily_revenue").first().total_revenue == 0


def test_refresh_fails_on_errors_after_writing_the_report(spark, tmp_path):
    wrong = [change("c", after=order(1, "LOST"))]
    with pytest.raises(RuntimeError, match="accepted_values stg_orders.status"):
        refresh(spark, bronze(spark, wrong), str(tmp_path), prefix="two_")
    assert spark.table("two_meta.dq_report").where("verdict = 'error'").count() == 2


def test_orphan_lines_only_warn(spark, tmp_path):
    tables = refresh(spark, bronze(spark, [change("c", after=order(2, "PAID"))]), str(tmp_path), prefix="three_")
    warned = tables["dq_report"].where("verdict = 'warn'")
    assert sorted((r.table_name, r.violations) for r in warned.collect()) == [("core_order_items", 1), ("stg_order_items", 1)]
