"""Schedule periods, validity intervals and event-time buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def period_index(day: Column, epoch: dt.date, step_days: int) -> Column:
    """Number of the schedule period that holds ``day``; period 0 starts at ``epoch``."""
    return F.floor(F.datediff(day, F.lit(epoch)) / F.lit(step_days)).cast("int")


def period_start(day: Column, epoch: dt.date, step_days: int) -> Column:
    """First day of the schedule period that holds ``day``."""
    return F.date_add(F.lit(epoch), period_index(day, epoch, step_days) * F.lit(step_days))


def overlaps(start: Column, end: Column, low: dt.date, high: dt.date) -> Column:
    """The closed interval [start, end] shares at least one day with [low, high]."""
    return (start <= F.lit(high)) & (end >= F.lit(low))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 for a zoned or zone-less timestamp (UTC session)."""
    return F.unix_micros(ts.cast("timestamp"))


def time_bucket(ts: Column, width_seconds: int) -> Column:
    """Index of the fixed-width time slot that holds ``ts``."""
    return F.call_function("div", epoch_micros(ts), F.lit(width_seconds * 1_000_000).cast("bigint"))


def month_text(month_start: Column) -> Column:
    return F.date_format(month_start, "yyyy-MM")
