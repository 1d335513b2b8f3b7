"""Record cleaning: value maps, defaults, required keys, validity floor, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.money import line_revenue
from sparkretail.operators.windows import latest_per_key


@dataclass(frozen=True)
class CleaningRules:
    """What a valid record is. The order of application is fixed in ``clean``."""

    replacements: dict[str, dict[str, str]] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)
    required: Sequence[str] = ()
    ranges: dict[str, tuple[Any, Any]] = field(default_factory=dict)  # low < value <= high
    allowed: dict[str, Sequence[Any]] = field(default_factory=dict)


# Accepted spellings and bounds of a sales record.
SALES_RULES = CleaningRules(
    replacements={
        "currency": {"usd": "USD", "$": "USD", "eur": "EUR", "gbp": "GBP"},
        "status": {"complete": "COMPLETED", "Complete": "COMPLETED", "completed": "COMPLETED"},
    },
    defaults={"discount_pct": 0, "currency": "USD"},
    required=("product_id",),
    ranges={"quantity": (0, 100)},
    allowed={"currency": ("USD", "EUR", "GBP"), "status": ("COMPLETED",)},
)


def in_range(column: str, low: Any, high: Any) -> Column:
    """Present, above ``low`` and at most ``high``."""
    c = F.col(column)
    return c.isNotNull() & (c > low) & (c <= high)


def map_values(column: str, mapping: dict[str, str]) -> Column:
    """Replace exact spellings, keep every other value. Same result as
    ``DataFrame.replace``, as one lookup instead of a comparison per spelling: a floor
    that is pushed below this step copies the expression."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), F.col(column))


def clean(df: DataFrame, rules: CleaningRules = SALES_RULES) -> DataFrame:
    """Map spellings, fill defaults, drop rows without their keys, keep the valid rest.

    The order matters: a default counts as a value in the floor, and a mapped spelling
    counts as the spelling it maps to. One narrow stage, no shuffle.
    """
    df = df.withColumns({c: map_values(c, m) for c, m in rules.replacements.items()})
    if rules.defaults:
        df = df.fillna(rules.defaults)
    if rules.required:
        df = df.dropna(subset=list(rules.required))
    for column, (low, high) in rules.ranges.items():
        df = df.filter(in_range(column, low, high))
    for column, values in rules.allowed.items():
        keep = F.col(column) == values[0] if len(values) == 1 else F.col(column).isin(*values)
        df = df.filter(keep)
    return df


def floor(df: DataFrame, channels: Sequence[str] = ("POS",), status: str = "COMPLETED") -> DataFrame:
    """The population most store reports start from. Apply it before any distinct,
    sample or aggregate, the other order gives a different answer."""
    where = F.col("channel") == channels[0] if len(channels) == 1 else F.col("channel").isin(*channels)
    return df.filter(where & (F.col("status") == status))


def add_line_revenue(df: DataFrame, precision: int = 12, on_overflow: str = "error") -> DataFrame:
    """Every input column plus ``revenue``."""
    return df.withColumn(
        "revenue",
        line_revenue("quantity", "unit_price", "discount_pct", precision, on_overflow),
    )


def valid_line_revenue(df: DataFrame, rules: CleaningRules = SALES_RULES) -> DataFrame:
    """Validity floor without repairs, then line revenue: one stage, no shuffle."""
    valid = clean(df, CleaningRules(ranges=rules.ranges, allowed=rules.allowed))
    return add_line_revenue(valid, precision=18)


def collapse_tickets(df: DataFrame, channel: str = "POS") -> DataFrame:
    """Trim ticket ids, keep one channel, keep one row per id (which one is not defined).

    The aggregate behind ``dropDuplicates`` combines map-side, so a ticket written a
    billion times shuffles one row per task.
    """
    return (
        df.withColumn("txn_id", F.trim("txn_id"))
        .filter(F.col("channel") == channel)
        .dropDuplicates(["txn_id"])
    )


def collapse_tickets_ordered(
    df: DataFrame, order: Sequence[Column], channel: str = "POS"
) -> DataFrame:
    """As ``collapse_tickets`` for copies that differ: the first row in ``order`` stays."""
    trimmed = df.withColumn("txn_id", F.trim("txn_id")).filter(F.col("channel") == channel)
    return latest_per_key(trimmed, ["txn_id"], order)


def split_on(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds, and all others. A NULL predicate counts as false,
    so no row is lost between the two halves."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.filter(holds), df.filter(~holds)
