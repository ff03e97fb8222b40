"""The registered queries: each runs over whole tables in ``folder``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.domain import CITY_WEIGHTS, CREATE_OPS, INVENTORY, KEYS
from tidemark.functions.envelope import between, drop_redelivered, envelope, extract, images, quarantine
from tidemark.lake import Lake, lake
from tidemark.operators import quality
from tidemark.operators.assign import weighted_assignment
from tidemark.operators.state import latest_by_key, soft_delete, stage, staged, state_as_of
from tidemark.plans import alerts, analyses, checks, core, cut, incremental, live, marts, refresh, surface, upkeep
from tidemark.session import scratch
from tidemark.sources import changelog
from tidemark.sources.offsets import stream_log
from tidemark.sources.tables import read_table
from tidemark.streaming import alerts as alert_stream
from tidemark.streaming import jobs
from tidemark.streaming.sinks import AT_ONCE, drain

Query = Callable[[SparkSession, str], DataFrame]

#: 1998-07-01T00:00:00Z, a moment in the middle of the history.
CUTOFF_MS = 899_251_200_000

_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register a query under its own name. Timestamps come out without a zone (UTC)."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(lake(spark, folder))
        return result.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if f.dataType.typeName() == "timestamp"
                else F.col(f.name)
                for f in result.schema.fields
            ]
        )

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- bronze and staging -------------------------------------------------------------


@query
def bronze_envelope(at: Lake) -> DataFrame:
    return envelope(at.log("orders"), "order_id")


@query
def cdc_quarantine(at: Lake) -> DataFrame:
    bad = quarantine(changelog.damaged(at.log("orders")), "order_id")
    return bad.groupBy("reason", "kafka_partition").agg(F.count(F.lit(1)).alias("n"))


@query
def stg_orders(at: Lake) -> DataFrame:
    return at.stage("orders")


@query
def stg_users(at: Lake) -> DataFrame:
    return at.stage("users")


@query
def stg_products(at: Lake) -> DataFrame:
    return at.stage("products")


@query
def stg_order_items(at: Lake) -> DataFrame:
    return at.stage("order_items")


@query
def stg_orders_asof(at: Lake) -> DataFrame:
    return state_as_of(at.bronze("orders"), "orders", CUTOFF_MS)


@query
def cut_tables(at: Lake) -> DataFrame:
    """Rows of the four tables at the newest commit time that all their logs have reached."""
    return cut.cut_counts({entity: at.bronze(entity) for entity in KEYS})


@query
def cut_order_items(at: Lake) -> DataFrame:
    """Lines at the cutoff, or before where a log has not come so far; those without an order apart."""
    return cut.consistent_cut({entity: at.bronze(entity) for entity in KEYS}, CUTOFF_MS)["order_items"]


@query
def stg_orders_redelivered(at: Lake) -> DataFrame:
    """Latest state from a log in which records arrive more than once."""
    log = changelog.redelivered(at.log("orders"))
    return stage(envelope(log, "order_id"), "orders")


@query
def incremental_orders(at: Lake) -> DataFrame:
    """State up to the cutoff, then brought forward by the later changes."""
    bronze = at.bronze("orders")
    path = scratch(at.spark, "orders-state")
    incremental.write_state(between(bronze, last_ms=CUTOFF_MS), "orders", path)
    state = incremental.apply_changes(at.spark, bronze, "orders", path, CUTOFF_MS)
    return staged(state, "orders")


@query
def late_column(at: Lake) -> DataFrame:
    """A column the staging schema never knew, read from history."""
    events = extract(at.bronze("orders"), {"priority": ("$.priority", "string")})
    return events.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("orders"))


@query
def native_state(at: Lake) -> DataFrame:
    """Latest change per user of the events table, which is a change log of its own."""
    log = extract(changelog.native_log(at.spark, at.folder), {"k": ("$.k", "bigint")})
    return soft_delete(latest_by_key(log, ["user_id"])).select(
        "user_id", "op", "lsn", "measure", "k", "is_deleted"
    )


@query
def native_minutes(at: Lake) -> DataFrame:
    log = changelog.native_log(at.spark, at.folder).where(F.col("op") != "d")
    minute = F.window(F.timestamp_millis("ts_ms"), "1 minute")["start"]
    return log.groupBy(minute.alias("minute"), "op").agg(
        F.count(F.lit(1)).alias("n"), F.sum("measure").alias("total")
    )


# --- silver and gold ----------------------------------------------------------------


@query
def order_flags(at: Lake) -> DataFrame:
    return core.order_flags(at.stage("orders"))


@query
def core_orders(at: Lake) -> DataFrame:
    return core.core_orders(at.staged("orders"), at.staged("users"))


@query
def core_order_items(at: Lake) -> DataFrame:
    return core.core_order_items(at.staged("order_items"), at.staged("products"))


@query
def mart_daily_revenue(at: Lake) -> DataFrame:
    # The flags come from the order alone: the mart does not need the customer join.
    return marts.daily_revenue(core.order_flags(at.stage("orders")))


@query
def mart_sales_by_category(at: Lake) -> DataFrame:
    # Of the orders only status and deletion mark matter.
    items = core.core_order_items(at.staged("order_items"), at.staged("products"))
    return marts.sales_by_category(items, at.staged("orders"))


def _grown_state(at: Lake, entity: str) -> tuple[str, Callable[[], DataFrame]]:
    """The state of an entity up to the cutoff, and what brings it up to date."""
    path, bronze = scratch(at.spark, f"{entity}-state"), at.bronze(entity)
    incremental.write_state(between(bronze, last_ms=CUTOFF_MS), entity, path)
    return path, lambda: incremental.apply_changes(at.spark, bronze, entity, path, CUTOFF_MS)


@query
def mart_daily_upkeep(at: Lake) -> DataFrame:
    """The daily mart of the cutoff, brought forward by what the later changes make different."""
    path = scratch(at.spark, "daily")
    orders, grow = _grown_state(at, "orders")
    upkeep.refresh_daily(at.spark, orders, path)
    grow()
    return upkeep.refresh_daily(at.spark, orders, path)


@query
def mart_category_upkeep(at: Lake) -> DataFrame:
    """The category mart of the cutoff, brought forward likewise, from three states."""
    path = scratch(at.spark, "categories")
    states = [_grown_state(at, entity) for entity in ("orders", "order_items", "products")]
    folders = [folder for folder, _ in states]
    upkeep.refresh_category(at.spark, *folders, path)
    for _, grow in states:
        grow()
    return upkeep.refresh_category(at.spark, *folders, path)


@query
def order_header(at: Lake) -> DataFrame:
    return core.order_header(at.staged("orders"), at.staged("users"))


@query
def order_detail(at: Lake) -> DataFrame:
    header = core.order_header(at.staged("orders"), at.staged("users"))
    return core.order_lines(header, at.staged("order_items"), at.staged("products"))


# --- analyses -----------------------------------------------------------------------


@query
def order_history(at: Lake) -> DataFrame:
    return analyses.order_history(at.bronze("orders"))


@query
def time_to_payment(at: Lake) -> DataFrame:
    return analyses.time_to_payment(at.bronze("orders"))


@query
def cancellations_by_city(at: Lake) -> DataFrame:
    return analyses.cancellations_by_city(core.core_orders(at.staged("orders"), at.staged("users")))


@query
def order_funnel(at: Lake) -> DataFrame:
    return analyses.order_funnel(at.stage("orders", "status"))


@query
def burn_rate(at: Lake) -> DataFrame:
    return analyses.burn_rate(alerts.stock_readings(at.log(INVENTORY)))


@query
def top_customers(at: Lake) -> DataFrame:
    return analyses.top_customers(core.order_flags(at.stage("orders")), at.bronze("users"))


@query
def cancelled_recent(at: Lake) -> DataFrame:
    return analyses.cancelled_recently(at.bronze("orders"), hours=30 * 24)


@query
def best_category_month(at: Lake) -> DataFrame:
    items = core.core_order_items(at.staged("order_items"), at.staged("products"))
    return analyses.best_category_of_last_month(items, at.staged("orders"))


@query
def recent_orders(at: Lake) -> DataFrame:
    return analyses.recent_orders(at.stage("orders", "status", "total_amount"))


@query
def first_users(at: Lake) -> DataFrame:
    return analyses.first_users(at.stage("users"))


@query
def table_counts(at: Lake) -> DataFrame:
    return analyses.table_counts({entity: at.bronze(entity) for entity in KEYS})


@query
def assign_weighted(at: Lake) -> DataFrame:
    """A city for every customer, in proportion to the cities' weights."""
    customers = read_table(at.spark, at.folder, "customer").select("c_custkey")
    weights = at.spark.createDataFrame(list(CITY_WEIGHTS), "city string, pop bigint")
    return weighted_assignment(customers, weights, "city", "pop", F.col("c_custkey") * 7919)


# --- live ---------------------------------------------------------------------------


def _order_sums(at: Lake) -> DataFrame:
    return live.sum_deltas(live.order_deltas(live.order_changes(at.log("orders"))))


def _other_logs(at: Lake) -> DataFrame:
    return at.log("users").unionByName(at.log("products")).unionByName(at.log("order_items"))


def _metrics(at: Lake) -> DataFrame:
    return live.live_metrics(at.log("orders"), _other_logs(at), at.stage("users", "city"))


def _minutes(at: Lake) -> DataFrame:
    return live.trending_minute(live.item_changes(at.log("order_items")))


def _event_sums(at: Lake, *topics: str) -> DataFrame:
    logs = at.log(topics[0])
    for topic in topics[1:]:
        logs = logs.unionByName(at.log(topic))
    return live.sum_deltas(live.event_deltas(logs))


def _top(at: Lake, metrics: DataFrame) -> DataFrame:
    return live.trending_top(_minutes(at), live.last_minute(metrics), at.bronze("products"))


@query
def live_metrics(at: Lake) -> DataFrame:
    return _metrics(at)


@query
def live_metrics_redelivered(at: Lake) -> DataFrame:
    """The order metrics from a log with repeated records, each counted once."""
    changes = drop_redelivered(live.order_changes(changelog.redelivered(at.log("orders"))))
    sums = live.sum_deltas(live.order_deltas(changes))
    return live.with_cities(sums, live.user_city(at.stage("users", "city"))).drop("newest_ms")


@query
def live_order_total(at: Lake) -> DataFrame:
    return live.order_total(live.order_changes(at.log("orders")))


@query
def live_status_counts(at: Lake) -> DataFrame:
    return live.status_counts(live.order_changes(at.log("orders")))


@query
def live_net_revenue(at: Lake) -> DataFrame:
    return live.net_revenue(live.order_changes(at.log("orders")))


@query
def live_orders_by_city(at: Lake) -> DataFrame:
    cities = live.user_city(at.stage("users", "city"))
    return live.by_city(_order_sums(at), cities).select("city", "n").orderBy(F.desc("n"), "city")


@query
def live_events_processed(at: Lake) -> DataFrame:
    return live.events_processed(_event_sums(at, *KEYS))


@query
def dim_user_city(at: Lake) -> DataFrame:
    return live.user_city(at.stage("users", "city"))


@query
def dim_product_name(at: Lake) -> DataFrame:
    return live.product_name(at.stage("products", "name"))


@query
def asof_city(at: Lake) -> DataFrame:
    created = images(at.log("orders"), "user_id:string").where(F.col("op").isin(*CREATE_OPS))
    creations = created.select(F.col("after")["user_id"].try_cast("bigint").alias("user_id"), "lsn")
    city = F.when(F.col("op") == "d", live.DEFAULT_CITY).otherwise(F.col("city"))
    versions = extract(at.bronze("users"), {"city": ("$.city", "string")}).withColumn("city", city)
    return analyses.orders_by_city_then(creations, versions)


@query
def trending_minute(at: Lake) -> DataFrame:
    return _minutes(at)


@query
def trending_top(at: Lake) -> DataFrame:
    return _top(at, _event_sums(at, "orders", "order_items"))


@query
def trending_sliding(at: Lake) -> DataFrame:
    return live.trending_sliding(_minutes(at))


@query
def live_summary(at: Lake) -> DataFrame:
    path = scratch(at.spark, "metrics")
    _metrics(at).write.parquet(path)
    published = at.spark.read.parquet(path)
    return live.live_summary(published, _top(at, published))


@query
def live_vs_batch_drift(at: Lake) -> DataFrame:
    sums = live.sum_deltas(live.order_deltas(live.order_changes(at.log("orders")), by_user=False))
    return live.drift(sums, core.order_flags(at.stage("orders")))


@query
def stock_alerts(at: Lake) -> DataFrame:
    return alerts.stock_alerts(alerts.stock_readings(at.log(INVENTORY)))


# --- streams, run over the whole log to its end -------------------------------------

#: Rate limit: records of a topic per micro-batch; and the batches that a backlog is dealt over, if more
#: records each make them fewer.
BATCH = 250_000
BACKLOG_BATCHES = 20


@query
def bronze_stream(at: Lake) -> DataFrame:
    root = scratch(at.spark, "stream")
    logs = {
        entity: stream_log(
            at.spark, at.log_path(entity), [entity], jobs.bronze_checkpoint(root, entity), records=BATCH, batches=BACKLOG_BATCHES
        )
        for entity in KEYS
    }
    drain(*jobs.ingest(logs, root, every=AT_ONCE))
    counts = [
        jobs.read_bronze(at.spark, root, entity)
        .groupBy("op")
        .agg(F.count(F.lit(1)).alias("n"), F.max("lsn").alias("max_lsn"))
        .select(F.lit(entity).alias("table_name"), "op", "n", "max_lsn")
        for entity in KEYS
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query
def live_metrics_stream(at: Lake) -> DataFrame:
    root = scratch(at.spark, "stream")
    log = stream_log(
        at.spark, at.log_path(*KEYS), tuple(KEYS), f"{root}/checkpoints/metrics", records=4 * BATCH, batches=BACKLOG_BATCHES
    )

    def known(buyers: DataFrame) -> DataFrame:
        return stage(at.bronze("users").join(buyers, "user_id", "left_semi"), "users", "city")

    drain(jobs.live_counters(log, known, root, every=AT_ONCE))
    return jobs.read_metrics(at.spark, root)


@query
def trending_minute_stream(at: Lake) -> DataFrame:
    root = scratch(at.spark, "stream")
    log = stream_log(
        at.spark, at.log_path("order_items"), ["order_items"], f"{root}/checkpoints/minutes", records=BATCH, batches=BACKLOG_BATCHES
    )
    drain(jobs.trending_minutes(log, root, every=AT_ONCE))
    return jobs.read_minutes(at.spark, root)


@query
def stock_alerts_stream(at: Lake) -> DataFrame:
    root = scratch(at.spark, "stream")
    log = stream_log(
        at.spark, at.log_path(INVENTORY), [INVENTORY], alert_stream.checkpoint(root), records=BATCH, batches=BACKLOG_BATCHES
    )
    drain(alert_stream.raise_alerts(log, root, every=AT_ONCE))
    return alert_stream.read_alerts(at.spark, root)


# --- checks -------------------------------------------------------------------------


def _built(at: Lake) -> dict[str, DataFrame]:
    """Silver and gold as tables, built once per lake: checks read what was written."""
    if at.built is None:
        bronze = {entity: at.bronze(entity) for entity in KEYS}
        at.built = refresh.refresh(
            at.spark, bronze, at.root, layers=("staging", "silver", "gold"), prefix=at.prefix
        )
    return at.built


@query
def refresh_job(at: Lake) -> DataFrame:
    """The nightly job from bronze to its report: checks of rows are counted by the writes."""
    bronze, root = {entity: at.bronze(entity) for entity in KEYS}, scratch(at.spark, "refresh")
    return refresh.refresh(at.spark, bronze, root, prefix=f"job_{root[-8:]}_")["dq_report"]


@query
def dq_report(at: Lake) -> DataFrame:
    return checks.dq_report(at.spark, _built(at))


@query
def dq_not_null(at: Lake) -> DataFrame:
    tables = _built(at)
    return _count_checks(at, tables, "not_null")


def _faulty(at: Lake, entity: str) -> DataFrame:
    """Staging of an entity as a faulty source would give it."""
    return stage(envelope(changelog.faulty(at.log(entity)), KEYS[entity]), entity)


def _declared(kind: str, table: str, column: str) -> quality.Check:
    return next(c for c in checks.CHECKS if (c.kind, c.table, c.column) == (kind, table, column))


@query
def dq_accepted_values(at: Lake) -> DataFrame:
    """The declared check on statuses, over orders of which some have others."""
    return quality.column_checks(_faulty(at, "orders"), [_declared("accepted_values", "stg_orders", "status")])


@query
def dq_unique(at: Lake) -> DataFrame:
    """Keys held by more than one bronze row, per entity: every version is kept there."""
    results = [
        quality.unique(at.bronze(entity), quality.Check(f"bronze.{entity}", "unique", key))
        for entity, key in KEYS.items()
    ]
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    return found


@query
def dq_relationships(at: Lake) -> DataFrame:
    """The declared check on lines, some of whose orders never arrived."""
    check = _declared("relationships", "stg_order_items", "order_id")
    found = quality.relationships(at.stage("order_items", "order_id"), _faulty(at, "orders"), check)
    verdict = quality.severity(F.col("violations"), F.lit(check.warn), F.lit(check.error))
    return found.withColumn("verdict", verdict)


@query
def dq_category_non_negative(at: Lake) -> DataFrame:
    items = core.core_order_items(_faulty(at, "order_items"), at.staged("products"))
    return checks.category_non_negative(marts.sales_by_category(items, at.staged("orders")))


@query
def dq_daily_counts(at: Lake) -> DataFrame:
    """No day breaks this one: a mart counts its cancelled orders among its orders."""
    return checks.daily_counts(_built(at)["mart_daily_revenue"])


@query
def dq_daily_non_negative(at: Lake) -> DataFrame:
    return checks.daily_non_negative(marts.daily_revenue(core.order_flags(_faulty(at, "orders"))))


@query
def dq_revenue_reconciliation(at: Lake) -> DataFrame:
    """A mart of the orders that arrived against all orders: days that differ."""
    mart = marts.daily_revenue(core.order_flags(_faulty(at, "orders")))
    return checks.revenue_reconciliation(mart, _built(at)["core_orders"])


def _count_checks(at: Lake, tables: dict[str, DataFrame], kind: str) -> DataFrame:
    wanted = tuple(c for c in checks.CHECKS if c.kind == kind)
    return quality.report(at.spark, wanted, tables, {})


@query
def guarded_sql(at: Lake) -> DataFrame:
    """A user's own query through the read-only guard."""
    _built(at)
    return surface.safe_sql(
        at.spark,
        f"""
        SELECT city, count(*) AS total_orders, sum(paid_amount) AS spend
        FROM {at.prefix}silver.core_orders WHERE NOT is_deleted GROUP BY city;
        """,
    )
