"""Rollups of priced transactions. Fees are rounded per transaction, then summed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.dates import month_text
from sparkretail.functions.money import fee_cents, money_total, units, wide_sum

# Fixed value: fees above this amount are reviewed.
REVIEW_FEE = Decimal("0.25")

_FEE = "_fee"


def _with_fee(priced: DataFrame) -> DataFrame:
    return priced.withColumn(_FEE, fee_cents("amount", "rate_bps", "fixed_fee"))


def settle_by_entry(priced: DataFrame) -> DataFrame:
    """Country x entry mode: transactions, fee total, distinct rate versions used.

    Rows are first combined per rate version. That shrinks them map-side to the number
    of versions, and counting the combined rows then *is* the distinct count, so no
    separate distinct pass over the transactions is needed.
    """
    per_version = (
        _with_fee(priced)
        .groupBy("country_code", "entry_mode", "rate_id")
        .agg(F.count(F.lit(1)).alias("n"), wide_sum(F.col(_FEE)).alias("fee"))
    )
    return per_version.groupBy("country_code", "entry_mode").agg(
        F.sum("n").alias("txn_count"),
        money_total(F.sum("fee")).alias("total_fee"),
        F.count("rate_id").alias("distinct_rate_versions_used"),
    )


def settle_by_month(priced: DataFrame, review_fee: Decimal = REVIEW_FEE) -> DataFrame:
    """Country x month: approved volume, fee total, transactions above the review fee.

    Grouping is on the first day of the month; the ``yyyy-MM`` text is made once per
    group instead of once per transaction.
    """
    limit = F.lit(int(review_fee * 100)).cast("bigint")
    return (
        _with_fee(priced)
        .groupBy("country_code", F.trunc(F.to_date("txn_ts"), "month").alias("month"))
        .agg(
            wide_sum(units("amount", 2)).alias("gmv"),
            wide_sum(F.col(_FEE)).alias("fee"),
            F.count_if(F.col(_FEE) > limit).alias("review_txns"),
        )
        .select(
            "country_code",
            month_text(F.col("month")).alias("txn_month"),
            money_total(F.col("gmv")).alias("approved_gmv"),
            money_total(F.col("fee")).alias("interchange_fee_total"),
            "review_txns",
        )
    )


def month_totals(by_month: DataFrame) -> DataFrame:
    """One-row check totals over ``settle_by_month``."""
    return by_month.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("approved_gmv").cast("decimal(24,2)").alias("gmv"),
        F.sum("interchange_fee_total").cast("decimal(24,2)").alias("fee"),
        F.sum("review_txns").alias("review_txns"),
    )


def row_totals(priced: DataFrame) -> DataFrame:
    """One-row check totals over row-level priced output: row count and fee sum."""
    return _with_fee(priced).agg(
        F.count(F.lit(1)).alias("priced_rows"),
        money_total(wide_sum(F.col(_FEE)), 24).alias("fee_total"),
    )


def strategy_totals(by_strategy: dict[str, DataFrame]) -> DataFrame:
    """Check totals of the same rollup under several plans, one row per plan."""
    rows = [
        month_totals(df).select(F.lit(name).alias("strategy"), "*")
        for name, df in by_strategy.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def plans_agree(totals: DataFrame) -> bool:
    """True when every plan in ``strategy_totals`` gave the same totals."""
    return totals.drop("strategy").distinct().count() == 1
