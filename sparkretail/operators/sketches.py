"""Distinct counts from sketches that are stored once and merged over any period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SLOTS = 12


def relative_error(log_slots: int = LOG_SLOTS) -> float:
    """One standard deviation of an estimate, as a share of the count."""
    return 1.04 / (1 << log_slots) ** 0.5


def sketched(df: DataFrame, keys: Sequence[str], value: Column, log_slots: int = LOG_SLOTS) -> DataFrame:
    """One sketch of the distinct ``value`` per key: at most some kilobytes, whatever the
    number of rows. Sketches are built map-side, so a key with a third of all rows sends
    one per task. Nulls do not count; a key without values has an empty sketch."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(log_slots)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys from stored ones; the rows behind them are not read."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct") -> DataFrame:
    """``sketches`` with the estimated number of distinct values in place of the sketch."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
