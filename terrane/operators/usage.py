"""Usage reports over an event table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_bounds(name: str, today: date) -> tuple[str | None, str | None]:
    """First day and the day after the last of a named period: current_month, last_month, past_30_days, past_90_days, past_12_months, all."""
    first = today.replace(day=1)
    if name == "all":
        return None, None
    if name == "last_month":
        return (first - timedelta(days=1)).replace(day=1).isoformat(), first.isoformat()
    start = {
        "current_month": first,
        "past_30_days": today - timedelta(days=30),
        "past_90_days": today - timedelta(days=90),
        "past_12_months": first.replace(year=first.year - 1),
    }[name]
    return start.isoformat(), (today + timedelta(days=1)).isoformat()


def in_period(events: DataFrame, start: str | None, end: str | None, ts: str = "ts") -> DataFrame:
    """Events from ``start`` (included) to ``end`` (excluded); the bounds reach the scan."""
    if start:
        events = events.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    return events.where(F.col(ts) < F.lit(end).cast("timestamp_ntz")) if end else events


def usage_timeline(events: DataFrame, item: str, group: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """``date, item, n``: events a day and item, of the event types in ``group``."""
    e = in_period(events, start, end)
    e = e.where(F.col("event_type").isin(group)) if group else e
    return e.groupBy(F.to_date("ts").alias("date"), F.col(item).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("n"))


def usage_top(events: DataFrame, item: str, n: int = 10, group: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """The ``n`` items with most events, ties by item; ``rank`` from 1. The limit is the report."""
    e = in_period(events, start, end)
    e = e.where(F.col("event_type").isin(group)) if group else e
    counts = e.groupBy(F.col(item).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "item").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "item")).cast("bigint"))
