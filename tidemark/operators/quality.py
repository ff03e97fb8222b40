"""Declarative data checks: each counts its violations, thresholds turn them into a verdict."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_PER_COLUMN = ("not_null", "accepted_values")


@dataclass(frozen=True)
class Check:
    """One check on a column; with the defaults any violation is an error."""

    table: str
    kind: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    warn: int = 0
    error: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}" if self.column else f"{self.kind}:{self.table}"


def severity(violations: Column, warn: Column, error: Column) -> Column:
    return F.when(violations > error, "error").when(violations > warn, "warn").otherwise("pass")


def _named(name: str, count: Column) -> list[Column]:
    return [F.lit(name).alias("name"), count.cast("bigint").alias("violations")]


def column_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """All not-null and accepted-values checks of one table in one pass.

    A row yields one (check, value) pair per failure, so clean data yields nothing.
    Not-null counts rows, accepted-values counts distinct bad values; nulls pass the
    latter.
    """
    failures = []
    for check in checks:
        failure = F.struct(
            F.lit(check.name).alias("name"),
            F.lit(check.kind == "not_null").alias("by_row"),
            F.col(check.column).cast("string").alias("value"),
        )
        failures.append(F.when(_bad(check), failure))
    found = df.select(F.explode(F.filter(F.array(*failures), lambda f: f.isNotNull())).alias("f")).select("f.*")
    values = found.groupBy("name", "by_row", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("name").agg(
        F.sum(F.when(F.col("by_row"), F.col("n")).otherwise(1)).cast("bigint").alias("violations")
    )


def _bad(check: Check) -> Column:
    column = F.col(check.column)
    return column.isNull() if check.kind == "not_null" else ~column.isin(*check.values)


def observed(df: DataFrame, checks: Iterable[Check], rules: dict[str, Column] | None = None) -> tuple[DataFrame, Observation | None]:
    """``df`` with the failing rows of its column checks counted by the very job that writes it.

    ``rules`` adds assertions about single rows, by check name. The counts stand in the
    observation once the job is done. Counted at the top of the plan, in the tasks of its last
    stage, of which each partition's result is taken once, a repeated task changes nothing.
    """
    failing = {c.name: _bad(c) for c in checks if c.kind in _PER_COLUMN} | (rules or {})
    if not failing:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(bad).alias(name) for name, bad in failing.items()]), seen


def unique(df: DataFrame, check: Check) -> DataFrame:
    """Number of key values that occur more than once; nulls are left to not-null."""
    keys = df.where(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count(F.lit(1)).alias("n"))
    return keys.where("n > 1").agg(*_named(check.name, F.count(F.lit(1))))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys with no parent row, and the number of child rows that hold them.

    Counted per key first: a hot key crosses the join as one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def relationships(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    missing = orphans(child, check.column, parent, check.parent_column)
    return missing.agg(*_named(check.name, F.coalesce(F.sum("n"), F.lit(0))))


def key_checks(tables: dict[str, DataFrame], checks: Iterable[Check]) -> list[DataFrame]:
    """All unique and relationship checks, one grouping for each key that they are about.

    The keys of every table that a check names are stacked and counted by table, in the map
    tasks first; a key that occurs twice in one table, or in a child but not in its parent,
    shows in the counts. A table is read once for a key, however many checks ask for it.
    """
    domains: dict[tuple, list[Check]] = {}
    for check in checks:
        column = check.parent_column or check.column
        kind = tables[check.table].schema[check.column].dataType
        domains.setdefault((column, kind.simpleString()), []).append(check)
    found = []
    for own in domains.values():
        sides = [(c.table, c.column) for c in own] + [(c.parent, c.parent_column) for c in own if c.parent]
        slots = {side: i for i, side in enumerate(dict.fromkeys(sides))}
        stacked = [
            tables[table].select(F.col(column).alias("key"), F.lit(i).alias("slot")).where("key is not null")
            for (table, column), i in slots.items()
        ]
        rows = stacked[0]
        for other in stacked[1:]:
            rows = rows.unionByName(other)
        counts = rows.groupBy("key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in slots.values()])

        def violations(check: Check) -> Column:
            n = F.col(f"n{slots[check.table, check.column]}")
            if check.kind == "unique":
                return F.count_if(n > 1)
            return F.coalesce(F.sum(F.when(F.col(f"n{slots[check.parent, check.parent_column]}") == 0, n)), F.lit(0))

        totals = counts.agg(*[violations(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(own)])
        named = [F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(own)]
        found.append(totals.select(F.inline(F.array(*named))))
    return found


def assertion(name: str, violators: DataFrame) -> DataFrame:
    """A query that must return no rows."""
    return violators.agg(*_named(name, F.count(F.lit(1))))


def report(
    spark: SparkSession,
    checks: Iterable[Check],
    tables: dict[str, DataFrame],
    violators: dict[str, DataFrame],
    counted: dict[str, int] | None = None,
) -> DataFrame:
    """Every check with its violations and verdict, passing ones included.

    ``violators`` maps the name of an assertion check to its query. ``counted`` has failing rows
    by check name, from :func:`observed`; what it settles is not looked for in the tables
    again. It does not settle an accepted-values check with failures, which counts distinct values.
    """
    checks, counted = list(checks), counted or {}
    settled = {c.name: counted[c.name] for c in checks if c.name in counted and (c.kind != "accepted_values" or not counted[c.name])}
    results = [spark.createDataFrame(list(settled.items()), "name string, violations bigint")]
    open_checks = [c for c in checks if c.name not in settled]
    for table in dict.fromkeys(c.table for c in open_checks):
        per_column = [c for c in open_checks if c.table == table and c.kind in _PER_COLUMN]
        if per_column:
            results.append(column_checks(tables[table], per_column))
    results.extend(key_checks(tables, [c for c in open_checks if c.kind in ("unique", "relationships")]))
    results.extend(assertion(c.name, violators[c.name]) for c in open_checks if c.kind == "assertion")
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    declared = spark.createDataFrame(
        [(c.name, c.table, c.column, c.kind, c.warn, c.error) for c in checks],
        "name string, table_name string, column_name string, kind string, warn bigint, error bigint",
    )
    violations = F.coalesce("violations", F.lit(0))
    return declared.join(found, "name", "left").select(
        "table_name",
        "column_name",
        "kind",
        violations.alias("violations"),
        severity(violations, F.col("warn"), F.col("error")).alias("verdict"),
    )
