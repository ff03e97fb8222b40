"""What the physical plans must and must not hold, whatever the data size."""

import pytest

from conftest import FOLDER
from tidemark import registry
from tidemark.lake import lake
from tidemark.sources.log import read_log

STREAMS = {name for name in registry.queries() if name.endswith("_stream")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - STREAMS))
def test_no_all_pairs_join_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


@pytest.mark.parametrize("entity", ["orders", "order_items"])
def test_old_versions_stay_in_their_map_task(spark, entity):
    text = plan(lake(spark, FOLDER).stage(entity))
    # Newest operator first: ranked and cut on both sides of the only shuffle.
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before
    # The payload is parsed once, above the ranking.
    assert text.count("from_json") == 1
    assert text.index("from_json") < text.index("Window")


def test_reads_are_pruned(spark):
    text = plan(lake(spark, FOLDER).bronze("orders").where("op = 'd'").select("order_id"))
    assert "PushedFilters: [IsNotNull(op), EqualTo(op,d)]" in text
    assert "ReadSchema: struct<op:string,order_id:bigint>" in text
    log = plan(read_log(spark, lake(spark, FOLDER).log_path("orders"), ["orders"]).select("offset"))
    assert " = orders)], PushedFilters: []" in log and "ReadSchema: struct<offset:bigint>" in log


def test_envelope_is_parsed_once(spark):
    text = plan(registry.queries()["bronze_envelope"](spark, FOLDER))
    assert text.count("from_json") == 1
    assert "Exchange" not in text


def test_hot_customers_are_summed_before_the_join(spark):
    text = plan(registry.queries()["live_orders_by_city"](spark, FOLDER))
    order_side = text[text.index("Join") :]
    assert "partial_count(1)" in order_side
