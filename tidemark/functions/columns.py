"""Column expressions shared by the batch and the streaming plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.domain import REVENUE_STATUSES


def or_default(column: Column, default: str | Column) -> Column:
    """``default`` where the text is missing; an empty string counts as missing."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(column, F.lit("")), fallback)


def is_revenue(status: Column) -> Column:
    return F.coalesce(status.isin(*REVENUE_STATUSES), F.lit(False))


def paid_amount(status: Column, amount: Column) -> Column:
    """The amount while it counts as revenue, else 0; an unknown amount stays unknown."""
    zero = F.lit(0).cast("decimal(12,2)")
    return F.when(is_revenue(status), amount).otherwise(zero)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def event_time(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def event_minute(ts_ms: Column) -> Column:
    return F.date_trunc("minute", event_time(ts_ms))


def percent(part: Column, total: Column) -> Column:
    """Whole percent, halves to even, 0 where there is nothing to divide by."""
    share = part.cast("double") / total.cast("double") * 100
    return F.when(total > 0, F.bround(share, 0).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
