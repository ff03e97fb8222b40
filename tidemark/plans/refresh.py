"""The nightly job: bronze to staging, silver, gold, then the checks; stops on failure."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.domain import ALERT_SCHEMA, KEYS, bronze_schema
from tidemark.operators.quality import observed
from tidemark.operators.state import stage
from tidemark.plans.checks import CHECKS, dq_report, row_rules
from tidemark.plans.core import core_order_items, core_orders
from tidemark.plans.dictionary import data_dictionary
from tidemark.plans.marts import daily_revenue, sales_by_category

LAYERS = ("staging", "silver", "gold", "checks")
NAMESPACES = ("bronze", "staging", "silver", "gold", "ops", "meta")


def create_namespaces(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Namespaces, and the tables that streams append to, unless they exist."""
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name} LOCATION '{root}/{name}'")
    for entity, key in KEYS.items():
        create_table(spark, f"{prefix}bronze.{entity}", bronze_schema(key), f"{root}/bronze/{entity}")
    create_table(spark, f"{prefix}ops.stock_alerts", ALERT_SCHEMA, f"{root}/ops/stock_alerts")


def create_table(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """A table over a folder and its sub-folders, whose names are not columns of it. The files
    are listed anew, as streams may have added to them."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)


def replace_table(spark: SparkSession, df: DataFrame, name: str, root: str) -> DataFrame:
    """Full refresh: write a new folder, then point the table at it.

    Readers see the old rows until the whole new set is written, and keep them if the
    write fails. Old folders stay until the operator drops them.
    """
    path = f"{root}/{name.replace('.', '/')}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.parquet(path)
    known = spark.table(name).schema if spark.catalog.tableExists(name) else None
    if known and [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in written.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
        return written
    if known:  # an external table: dropping its definition leaves the files
        spark.sql(f"DROP TABLE {name}")
    create_table(spark, name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema), path)
    return written


def refresh(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str,
    layers: Sequence[str] = LAYERS,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Rebuild the layers asked for and return every table, with the ``dq_report``.

    Each table is written once, however many models and checks read it. Staging is read
    through views, which are pointed at the rows just written. Layers left out are read
    from the tables of an earlier run. The report is written before the job fails on
    errors. ``prefix`` goes before the namespaces, to keep several lakes in one catalog
    apart.
    """
    create_namespaces(spark, root, prefix)
    tables = {f"bronze.{entity}": df for entity, df in bronze.items()}
    counted: dict[str, int] = {}

    def build(layer: str, name: str, plan) -> None:
        full = f"{prefix}{layer}.{name}"
        if layer not in layers:
            tables[name] = spark.table(full)
            return
        # Checks of single rows are counted while the rows are written, and not read for again.
        watched, seen = observed(plan(), [c for c in CHECKS if c.table == name], row_rules(name))
        tables[name] = replace_table(spark, watched, full, root)
        counted.update(seen.get if seen else {})

    for entity, df in bronze.items():
        build("staging", f"stg_{entity}", lambda: stage(df, entity))
        tables[f"stg_{entity}"].createOrReplaceTempView(f"{prefix}stg_{entity}")
    build("silver", "core_orders", lambda: core_orders(tables["stg_orders"], tables["stg_users"]))
    build("silver", "core_order_items", lambda: core_order_items(tables["stg_order_items"], tables["stg_products"]))
    build("gold", "mart_daily_revenue", lambda: daily_revenue(tables["core_orders"]))
    build("gold", "mart_sales_by_category", lambda: sales_by_category(tables["core_order_items"], tables["core_orders"]))
    tables["data_dictionary"] = replace_table(spark, data_dictionary(spark).coalesce(1), f"{prefix}meta.data_dictionary", root)

    if "checks" in layers:
        result = replace_table(spark, dq_report(spark, tables, counted=counted), f"{prefix}meta.dq_report", root)
        tables["dq_report"] = result
        failed = result.where("verdict = 'error'").collect()  # 74 checks at most
        if failed:
            names = ", ".join(f"{r.kind} {r.table_name}.{r.column_name} ({r.violations})" for r in failed)
            raise RuntimeError(f"data checks failed: {names}")
    return tables
