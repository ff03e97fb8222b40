"""Streams give what the batch gives, batch after batch and after a replay."""

import os
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from conftest import change, make_log, order, rows
from tidemark.domain import KEYS, LOG_SCHEMA, bronze_schema
from tidemark.functions.envelope import envelope
from tidemark.plans import alerts, live
from tidemark.sources import offsets
from tidemark.sources.log import read_log, write_log
from tidemark.sources.offsets import LogReader, stream_log
from tidemark.streaming import alerts as alert_stream
from tidemark.streaming import jobs
from tidemark.streaming.sinks import (
    AT_ONCE,
    append_batch,
    drain,
    finish,
    fold_batch,
    merge_batch,
    read_appended,
    read_merged,
    read_newest,
)

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def orders(*statuses, first=0):
    return [change("c", after=order(first + i, s), lsn=first + i + 1) for i, s in enumerate(statuses)]


def test_ingest_appends_and_resumes(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    stream = lambda: {"orders": read_log(spark, log, ["orders"], streaming=True)}
    write_log(make_log(spark, "orders", orders("CREATED", "PAID")), log)
    finish(*jobs.ingest(stream(), root, every=None))
    write_log(make_log(spark, "orders", orders("SHIPPED", first=2), first=2), log)
    finish(*jobs.ingest(stream(), root, every=None))
    expected = envelope(read_log(spark, log, ["orders"]), "order_id")
    assert rows(jobs.read_bronze(spark, root, "orders")) == rows(expected)
    assert expected.count() == 3


def test_topics_are_kept_apart(spark, tmp_path):
    log = str(tmp_path / "log")
    write_log(make_log(spark, "orders", orders("PAID")), log)
    write_log(make_log(spark, "users", [change("r", after={"user_id": 1, "city": "X"})]), log)
    assert read_log(spark, log).count() == 2
    assert [r.topic for r in read_log(spark, log, ["users"]).collect()] == ["users"]
    late = read_log(spark, log, start="latest", since_ms=int(datetime(2024, 1, 2, tzinfo=timezone.utc).timestamp() * 1000))
    assert late.count() == 0


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    path = str(tmp_path / "table")
    sink, batch = append_batch(path), envelope(make_log(spark, "orders", orders("PAID")), "order_id")
    sink(batch, 0)
    sink(batch, 1)
    sink(batch, 1)
    assert read_appended(spark, path, bronze_schema(KEYS["orders"])).count() == 2


def test_replayed_fold_is_not_doubled(spark, tmp_path):
    path, schema = str(tmp_path / "sums"), jobs.METRIC_SCHEMA
    sink = fold_batch(path, schema, lambda before, batch, number: live.merge_sums(before.unionByName(batch)))
    batch = spark.createDataFrame([("m", "k", 1, 5)], "metric string, key string, value int, newest_ms bigint")
    batch = batch.withColumn("value", F.col("value").cast(live.MONEY))
    for number in (0, 1, 1, 2, 2):
        sink(batch, number)
    assert [int(r.value) for r in read_newest(spark, path, schema).collect()] == [3]


def test_live_counters_over_several_batches(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    users = spark.createDataFrame([(1, "Izmir", False)], "user_id bigint, city string, is_deleted boolean")
    parts = [
        orders("CREATED", "PAID"),
        [change("u", before=order(0), after=order(0, "PAID"))],
        [change("u", before=order(1, "PAID"), after=order(1, "REFUNDED")), change("d", before=order(1, "REFUNDED"))],
    ]
    for i, values in enumerate(parts):
        write_log(make_log(spark, "orders", values, first=10 * i), log)
    write_log(make_log(spark, "users", [change("r", after={"user_id": 1, "city": "Izmir"})]), log)
    stream = read_log(spark, log, ["orders", "users"], streaming=True, maxFilesPerTrigger="1")
    finish(jobs.live_counters(stream, lambda buyers: users, root, every=None))
    batch = live.live_metrics(read_log(spark, log, ["orders"]), read_log(spark, log, ["users"]), users)
    assert rows(jobs.read_metrics(spark, root)) == rows(batch)


def test_live_counters_leave_out_what_was_delivered_before(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    users = spark.createDataFrame([(1, "Izmir", False)], "user_id bigint, city string, is_deleted boolean")
    values = orders("CREATED", "PAID") + [change("u", before=order(0), after=order(0, "PAID"), lsn=9)]
    again = [value.replace('"ts_ms": 1000}}', '"ts_ms": 2000}}') for value in values]
    assert again != values
    for i, part in enumerate((values, again, values + orders("PAID", first=2))):
        write_log(make_log(spark, "orders", part, first=10 * i), log)
    stream = lambda: read_log(spark, log, ["orders"], streaming=True, maxFilesPerTrigger="1")
    finish(jobs.live_counters(stream(), lambda buyers: users, root, every=None))
    found = {(r.metric, r.key): int(r.value) for r in jobs.read_metrics(spark, root).collect()}
    assert found["orders_total", ""] == 3 and found["revenue_net", ""] == 30 and found["events_processed", "orders"] == 4
    finish(jobs.live_counters(stream(), lambda buyers: users, f"{root}/all", every=None, redelivered=False))
    found = {(r.metric, r.key): int(r.value) for r in jobs.read_metrics(spark, f"{root}/all").collect()}
    assert found["orders_total", ""] == 7


def test_merged_batches_survive_replay_and_folding(spark, tmp_path):
    path, schema = str(tmp_path / "minutes"), "minute timestamp, product_id bigint, units bigint"
    sink = merge_batch(path, schema, jobs.total_units, every=2)
    batch = lambda n: spark.createDataFrame([(1, n)], "product_id bigint, units bigint").selectExpr("timestamp_seconds(60) as minute", "product_id", "units")
    for number, units in ((0, 1), (1, 10), (1, 10), (2, 100), (3, 1000), (3, 1000), (4, 10000)):
        sink(batch(units), number)
        sink(batch(units), number)
    assert [r.units for r in read_merged(spark, path, schema, jobs.total_units).collect()] == [11111]
    assert [r.units for r in read_merged(spark, path, schema, jobs.total_units, before=3).collect()] == [111]


def test_late_lines_are_added_to_their_minutes(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    line = {"order_item_id": 1, "product_id": 1, "quantity": 2}
    for i, ts_ms in enumerate((60_000, 6 * 3_600_000, 61_000)):
        write_log(make_log(spark, "order_items", [change("c", after=line, ts_ms=ts_ms)], first=i), log)
    stream = read_log(spark, log, ["order_items"], streaming=True, maxFilesPerTrigger="1")
    finish(jobs.trending_minutes(stream, root, every=None))
    found = jobs.read_minutes(spark, root).select(F.unix_timestamp("minute"), "product_id", "units")
    assert rows(found) == [(60, 1, 4), (21600, 1, 2)]
    assert jobs.read_minutes(spark, root, kept=60).count() == 1


def inventory(spark, log, records, files=None):
    """Readings (offset, product, stock) as a log; with ``files``, one append per part in that order."""
    for part in files or [records]:
        rows = [("inventory", o % 2, o, T0, str(o), change("u", after={"product_id": p, "stock_qty": q}, ts_ms=o)) for o, p, q in part]
        write_log(spark.createDataFrame(rows, LOG_SCHEMA), log)


def alerted(spark, log, root, records=1000):
    stream = stream_log(spark, log, ["inventory"], alert_stream.checkpoint(root), records=records)
    drain(alert_stream.raise_alerts(stream, root, every=AT_ONCE))
    return rows(alert_stream.read_alerts(spark, root))


def batch_alerts(spark, log):
    return rows(alerts.stock_alerts(alerts.stock_readings(read_log(spark, log, ["inventory"]))))


def test_alerts_do_not_depend_on_the_order_of_files(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    chance = np.random.default_rng(5)
    # A product's readings stay in one partition: even products in partition 0.
    records = [(2 * i + p % 2, p, int(chance.integers(5, 15))) for i, p in enumerate(map(int, chance.integers(0, 6, 300)))]
    parts = [records[i : i + 50] for i in range(0, 300, 50)]
    inventory(spark, log, records, files=parts[::-1])
    files = sorted(Path(log).rglob("*.parquet"))
    for i, file in enumerate(reversed(files)):
        os.utime(file, (1_000_000 + i, 1_000_000 + i))
    assert alerted(spark, log, root, records=70) == batch_alerts(spark, log)
    assert len(list(Path(root, "ops/stock_alerts").glob("batch_id=*"))) >= 4
    assert alert_stream.late_readings(spark, root).count() == 0


def test_alert_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path)
    chance = np.random.default_rng(6)
    records = [(2 * i + p % 2, p, int(chance.integers(5, 15))) for i, p in enumerate(map(int, chance.integers(0, 5, 90)))]
    for at in range(0, 90, 30):
        inventory(spark, log, records[at : at + 30])
        found = alerted(spark, log, root, records=25)
    assert found == batch_alerts(spark, log) and len(found) > 5


def test_late_readings_are_kept_apart(spark, tmp_path):
    """A stream that does not come by offset: what arrives late changes nothing and is not lost."""
    log, root = str(tmp_path / "log"), str(tmp_path)
    for offset, stock in ((100, 3), (50, 20), (120, 4)):
        inventory(spark, log, [(offset, 2, stock)])
        stream = read_log(spark, log, ["inventory"], streaming=True)
        finish(alert_stream.raise_alerts(stream, root, every=None))
    assert [r.stock_qty for r in alert_stream.read_alerts(spark, root).collect()] == [3]
    assert [(r.kafka_offset, r.stock_qty) for r in alert_stream.late_readings(spark, root).collect()] == [(50, 20)]


def test_log_source_plans_by_offset(spark, tmp_path):
    log = str(tmp_path / "log")
    reader = lambda **more: LogReader({"path": log, "topics": "inventory", **more})
    assert reader().latestOffset() == {}
    inventory(spark, log, [(o, 1, o) for o in range(0, 400, 4)])
    inventory(spark, log, [(o, 1, o) for o in range(1000, 1100)])
    assert reader().latestOffset() == {"inventory/0": 1099, "inventory/1": 1100}
    assert reader(start="latest").initialOffset() == {"inventory/0": 1099, "inventory/1": 1100}
    some = reader(records="40")
    position, seen, batches = {}, [], 0
    while (end := some.latestOffset()) != position:
        got = [o for part in some.partitions(position, end) for batch in some.read(part) for o in batch.column("offset").to_pylist()]
        assert 1 <= len(got) <= 45
        seen, position, batches = seen + got, end, batches + 1
    assert sorted(seen) == [*range(0, 400, 4), *range(1000, 1100)] and batches >= 5
    for key in (0, 1):  # each partition in its order
        own = [o for o in seen if o % 2 == key]
        assert own == sorted(own)


def test_log_source_leaves_out_what_is_not_committed(spark, tmp_path):
    log = str(tmp_path / "log")
    inventory(spark, log, [(0, 1, 1)])
    marker = Path(log, "_SUCCESS").stat().st_mtime
    inventory(spark, log, [(2, 1, 1)])
    os.utime(Path(log, "_SUCCESS"), (marker, marker))
    assert LogReader({"path": log}).latestOffset() == {"inventory/0": 1}


def test_readings_of_many_products_in_one_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alert_stream, "BUCKETS", 2)
    log, root = str(tmp_path / "log"), str(tmp_path)
    chance = np.random.default_rng(7)
    records = [(2 * i + p % 2, p, int(chance.integers(5, 15))) for i, p in enumerate(map(int, chance.integers(0, 60, 900)))]
    inventory(spark, log, records)
    assert alerted(spark, log, root, records=200) == batch_alerts(spark, log)


def test_a_backlog_is_dealt_over_few_batches(spark, tmp_path):
    log = str(tmp_path / "log")
    inventory(spark, log, [(o, 1, o) for o in range(600)])
    reader = LogReader({"path": log, "topics": "inventory", "records": "10", "batches": "5"})
    position, sizes = {}, []
    while (end := reader.latestOffset()) != position:
        sizes.append(sum(batch.num_rows for part in reader.partitions(position, end) for batch in reader.read(part)))
        position = end
    assert sum(sizes) == 600 and len(sizes) <= 6 and max(sizes) <= 125
    capped = LogReader({"path": log, "topics": "inventory", "records": "10", "batches": "5", "most": "50"})
    end = capped.latestOffset()
    assert sum(batch.num_rows for part in capped.partitions({}, end) for batch in capped.read(part)) <= 55


def test_read_tasks_are_cut_by_records_not_offsets(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    monkeypatch.setattr(offsets, "TASK_RECORDS", 50)
    inventory(spark, log, [(o, 1, o) for o in range(0, 100_000, 1000)])
    reader = LogReader({"path": log, "topics": "inventory"})
    parts = reader.partitions({}, reader.latestOffset())
    assert len(parts) <= len(reader.files) + 100 // 50
    assert sorted(o for p in parts for b in reader.read(p) for o in b.column("offset").to_pylist()) == [*range(0, 100_000, 1000)]


def test_alert_state_has_few_stores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alert_stream, "STATE_TASKS", 2)
    log, root = str(tmp_path / "log"), str(tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    inventory(spark, log, [(2 * i, p, 5 + (i * 7 + p) % 10) for i, p in enumerate(list(range(40)) * 3)])
    assert alerted(spark, log, root, records=50) == batch_alerts(spark, log)
    stores = [d for d in Path(alert_stream.checkpoint(root), "state/0").iterdir() if d.name.isdigit()]
    assert len(stores) == 2 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_only_digests_at_the_places_of_a_batch_are_compared(spark, tmp_path):
    path = str(tmp_path / "seen")
    values = lambda *places: live.order_changes(
        make_log(spark, "orders", [change("c", after=order(1), lsn=lsn) for lsn in places]).withColumn("key", F.lit("1"))
    )
    assert jobs.new_changes(values(1, 5, None), path, 0).count() == 3
    found = jobs.new_changes(values(5, 6, None), path, 1)
    assert [r.lsn for r in found.collect()] == [6]
    kept = spark.read.schema("digest string, lsn bigint, batch_id bigint, topic string").parquet(path)
    assert sorted(r.lsn for r in kept.where((F.col("batch_id") < 1) & jobs._places(values(4, 6))).collect()) == [5]
    assert kept.where(jobs._places(values(7, 9))).count() == 0


def test_a_batch_is_neither_sorted_nor_shuffled_to_leave_out_what_came_before(spark, tmp_path, monkeypatch):
    log, root = str(tmp_path / "log"), str(tmp_path)
    users = spark.createDataFrame([(1, "Izmir", False)], "user_id bigint, city string, is_deleted boolean")
    values = orders("CREATED", "PAID", "PAID", "CREATED")
    for i, part in enumerate((values[:3], values[2:] + orders("PAID", first=7))):
        write_log(make_log(spark, "orders", part, first=10 * i).withColumn("key", F.get_json_object("value", "$.payload.after.order_id")), log)
    plans, settled = {}, jobs.settled

    def spy(df, path):
        plans.setdefault(os.path.basename(path), []).append(df._jdf.queryExecution().executedPlan().toString())
        return settled(df, path)

    monkeypatch.setattr(jobs, "settled", spy)
    stream = read_log(spark, log, ["orders"], streaming=True, maxFilesPerTrigger="1")
    finish(jobs.live_counters(stream, lambda buyers: users, root, every=None))
    found = {(r.metric, r.key): int(r.value) for r in jobs.read_metrics(spark, root).collect()}
    assert found["orders_total", ""] == 5 and found["orders_status", "PAID"] == 3
    assert all("SortAggregate" not in plan for plan in plans["changes"])
    assert len(plans["sums"]) == 2 and all("SortMergeJoin" not in plan and "sha2" not in plan for plan in plans["sums"])
    assert spark.read.parquet(f"{root}/seen_again").count() == 1


def test_copies_among_many_others_are_left_out(spark, tmp_path):
    path = str(tmp_path / "seen")

    def batch(places, topic="orders"):
        made = make_log(spark, topic, [change("c", after=order(1), lsn=lsn) for lsn in places]).withColumn("key", F.lit("1"))
        return jobs.with_digests(live.order_changes(made))

    places = [range(0, 50), range(40, 90), [None, 45, 89, 200], [None, 10, 200, 300]]
    known = set()
    for number, own in enumerate(places):
        for _ in range(2):  # a repeated batch finds the same
            found = jobs.new_changes(batch(own), path, number)
            assert "digest" not in found.columns
            assert {r.lsn for r in found.collect()} == set(own) - known
        known |= set(own)
    assert spark.read.parquet(path).count() == len(known)
    assert jobs.new_changes(batch([45], "users"), path, len(places)).count() == 1  # another topic's place
