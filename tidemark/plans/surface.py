"""Read-only SQL surface for people and agents: what there is, and guarded queries."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Statements that may start a query, words that may not occur in one.
READ_WORDS = ("select", "with", "show", "describe", "desc")
WRITE_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create",
    "truncate", "merge", "grant", "revoke", "call",
)
DISPLAY_ROWS = 100

_WORD = re.compile(r"[a-z0-9_]+")


class Rejected(ValueError):
    """The text is not a plain read."""


def catalog_tables(spark: SparkSession) -> DataFrame:
    """(namespace, table_name) of every table; temporary views are not listed."""
    rows = [
        (space.namespace, table.tableName)
        for space in spark.sql("SHOW NAMESPACES").toLocalIterator()
        for table in spark.sql(f"SHOW TABLES IN `{space.namespace}`").toLocalIterator()
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "namespace string, table_name string")


def catalog_columns(spark: SparkSession, table: str) -> DataFrame:
    """(col_name, data_type) of a table."""
    if not all(part.isidentifier() for part in table.split(".")):
        raise Rejected(f"{table!r} names no table")
    fields = spark.table(table).schema.fields
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in fields], "col_name string, data_type string"
    )


def check_read(text: str) -> str:
    """The statement without its end marks, if its words are those of a read.

    The test is on words alone: it also turns away harmless texts with such a word in a
    literal, or with a comment or a parenthesis in front.
    """
    statement = text.strip(" \t\r\n;")
    opening = re.match(r"[a-z]*", statement.lower()).group()
    if opening not in READ_WORDS:
        raise Rejected(f"a query starts with one of {', '.join(READ_WORDS)}; this one with {opening or 'no word'!r}")
    writes = sorted(set(_WORD.findall(statement.lower())) & set(WRITE_WORDS))
    if writes:
        raise Rejected(f"a query may not hold {', '.join(writes)}")
    return statement


def safe_sql(spark: SparkSession, text: str) -> DataFrame:
    """The result of a query that passes :func:`check_read`."""
    return spark.sql(check_read(text))


def as_text(df: DataFrame, cap: int = DISPLAY_ROWS) -> str:
    """The first rows as tab-separated text under their column names; no more are computed."""
    cells = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("\\N")).alias(name) for name in df.columns]
    rows = df.limit(cap + 1).select(*cells).collect()
    table = ["\t".join(df.columns), *("\t".join(row) for row in rows[:cap])]
    if len(rows) > cap:
        table.append(f"[first {cap} rows]")
    return "\n".join(table)


def run_query(spark: SparkSession, text: str) -> str:
    """Guarded query to text. The caller is an agent: it is told what went wrong, and retries."""
    try:
        return as_text(safe_sql(spark, text))
    except (Rejected, PySparkException) as reason:
        return f"not run: {reason}"


def list_tables(spark: SparkSession) -> str:
    return as_text(catalog_tables(spark).orderBy("namespace", "table_name"))


def describe_table(spark: SparkSession, table: str) -> str:
    try:
        return as_text(catalog_columns(spark, table))
    except (Rejected, PySparkException) as reason:
        return f"not described: {reason}"
