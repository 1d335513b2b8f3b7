"""Store-level reports and skew-safe group totals."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.money import (
    as_money,
    contribution_cents,
    money_total,
    revenue_cents,
    wide_sum,
)
from sparkretail.operators.clean import floor

OPEN_HOUR, CLOSE_HOUR = 9, 21
RSD = 0.05
QUARTILES = [0.25, 0.5, 0.75]


def business_hours(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Rows with 9 <= hour < 21 (UTC session)."""
    return df.filter((F.hour(ts) >= OPEN_HOUR) & (F.hour(ts) < CLOSE_HOUR))


def store_contribution(sales: DataFrame, precision: int = 12) -> DataFrame:
    """Contribution and tickets per store during business hours, any channel and status."""
    return (
        business_hours(sales)
        .withColumn("_line", contribution_cents("quantity", "unit_price", "discount_pct"))
        .groupBy("store_id")
        .agg(
            money_total(wide_sum(F.col("_line")), precision).alias("total_contribution"),
            F.count(F.lit(1)).alias("ticket_count"),
        )
        .orderBy("store_id")
    )


def _by_store_and_payment(sales: DataFrame) -> DataFrame:
    """Revenue and tickets of the store floor at the finest level of the two reports
    below. Both then work on a handful of rows per store instead of on the tickets."""
    return (
        floor(sales)
        .withColumn("_line", revenue_cents("quantity", "unit_price", "discount_pct"))
        .groupBy("store_id", "payment_method")
        .agg(wide_sum(F.col("_line")).alias("cents"), F.count(F.lit(1)).alias("tickets"))
    )


def store_payment_profile(sales: DataFrame, precision: int = 12) -> DataFrame:
    """Distinct payment methods (sorted array), revenue, tickets and variety per store."""
    return (
        _by_store_and_payment(sales)
        .groupBy("store_id")
        .agg(
            F.array_sort(F.collect_set("payment_method")).alias("payment_methods"),
            money_total(F.sum("cents"), precision).alias("total_revenue"),
            F.sum("tickets").alias("ticket_count"),
            F.count("payment_method").cast("int").alias("payment_variety"),
        )
        .orderBy("store_id")
    )


def store_rollup(sales: DataFrame, precision: int = 12, with_level: bool = False) -> DataFrame:
    """Detail rows, store subtotals and the grand total.

    ROLLUP copies its input once per level, so it runs on the store x payment totals, not
    on the tickets. ``with_level`` adds the grouping id (0 detail, 1 store, 3 grand
    total), which tells a subtotal's NULL from a NULL in the data.
    """
    out = (
        _by_store_and_payment(sales)
        .rollup("store_id", "payment_method")
        .agg(
            money_total(F.sum("cents"), precision).alias("total_revenue"),
            F.sum("tickets").alias("ticket_count"),
            F.grouping_id().alias("level"),
        )
        .orderBy(F.col("store_id").asc_nulls_last(), F.col("payment_method").asc_nulls_last())
    )
    return out if with_level else out.drop("level")


def store_segments(sales: DataFrame, accuracy: int = 10_000, precision: int = 10) -> DataFrame:
    """Approximate distinct customers and revenue quartiles per store, exact tickets.

    The quartiles are elements of the data, as Spark defines them, not interpolated. Both
    sketches merge map-side, so a store with a third of all rows is one sketch per task.
    """
    return (
        floor(sales, channels=("POS", "ONLINE"))
        .withColumn("_line", revenue_cents("quantity", "unit_price", "discount_pct"))
        .groupBy("store_id")
        .agg(
            F.approx_count_distinct("customer_id", rsd=RSD).alias("approx_unique_customers"),
            F.percentile_approx("_line", QUARTILES, accuracy).alias("q"),
            F.count(F.lit(1)).alias("total_transactions"),
        )
        .select(
            "store_id",
            "approx_unique_customers",
            as_money(F.col("q")[0], precision).alias("revenue_p25"),
            as_money(F.col("q")[1], precision).alias("revenue_p50"),
            as_money(F.col("q")[2], precision).alias("revenue_p75"),
            "total_transactions",
        )
        .orderBy("store_id")
    )


def store_distinct_customers(sales: DataFrame) -> DataFrame:
    """Exact distinct customers per store, the slow counterpart of the sketch above."""
    return (
        floor(sales, channels=("POS", "ONLINE"))
        .groupBy("store_id")
        .agg(F.count_distinct("customer_id").alias("unique_customers"))
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def customer_totals(tx: DataFrame, key: str, amount_cents: Column, precision: int = 18) -> DataFrame:
    """Transactions, total, smallest, largest and mean amount per customer.

    Every figure combines before the shuffle, so a customer with half of all rows sends
    one row per task. The mean is total / count, rounded half-up to cents.
    """
    cents = F.col("_cents")
    n = F.count(F.lit(1)).cast("decimal(18,0)")
    total = wide_sum(cents).cast("decimal(30,0)")
    # Half-up on whole numbers: (2 total + n) div 2n, mirrored below zero.
    doubled = total * F.lit(Decimal(2)) + F.when(total < 0, -n).otherwise(n)
    mean = F.call_function("div", doubled, n * F.lit(Decimal(2)))
    return tx.withColumn("_cents", amount_cents).groupBy(key).agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_total(total, precision).alias("total_amount"),
        as_money(F.min(cents), precision).alias("min_amount"),
        as_money(F.max(cents), precision).alias("max_amount"),
        as_money(mean, precision).alias("avg_amount"),
    )


def run_statistics(
    runs: DataFrame,
    variant: str,
    metrics: Sequence[str],
    state: str = "terminal_state",
    done: str = "COMPLETED",
) -> DataFrame:
    """Mean, smallest and largest value of every metric per variant, completed runs only.

    A missing metric of a completed run is left out of that metric's figures.
    """
    aggs = reduce(
        lambda acc, m: acc
        + [
            F.round(F.avg(m), 2).alias(f"{m}_avg"),
            F.round(F.min(m), 2).alias(f"{m}_min"),
            F.round(F.max(m), 2).alias(f"{m}_max"),
        ],
        metrics,
        [F.count(F.lit(1)).alias("completed_runs")],
    )
    return runs.filter(F.col(state) == done).groupBy(variant).agg(*aggs)
