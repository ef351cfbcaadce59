"""Clock-free time expressions; callers pass every time in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def display_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def micro_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmssSSSSSS")


def age_seconds(as_of: Column, ts: Column) -> Column:
    """Seconds between two timestamps, with their fraction."""
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(1_000_000)


def older_than(as_of: Column, ts: Column, ttl_s: int) -> Column:
    return F.unix_micros(as_of) - F.unix_micros(ts) > F.lit(ttl_s * 1_000_000)


def batch_count(total: Column, batch_size: Column) -> Column:
    return F.ceil(total / batch_size)


def processed_after(batch: Column, batch_size: Column, total: Column) -> Column:
    return F.least(batch * batch_size, total)


def progress_percent(batch: Column, batch_size: Column, total: Column) -> Column:
    """Share of ``total`` done after ``batch`` batches, in percent; null for an empty total."""
    return processed_after(batch, batch_size, total) / F.nullif(total, F.lit(0)) * F.lit(100)
