"""Latest version per key and checks on versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in ``order``; add enough columns to make it unambiguous.

    The rank filter lets Spark put a per-task group limit before the shuffle, so a key
    with very many versions sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def current_catalog(catalog: DataFrame) -> DataFrame:
    """Newest version per product; among versions of one day, the first name."""
    slim = catalog.select(
        "product_id", "product_name", "category", "brand", "list_price", "effective_ts"
    )
    return latest_per_key(
        slim, ["product_id"], [F.col("effective_ts").desc(), F.col("product_name").asc()]
    )


def overlapping_versions(
    df: DataFrame, keys: Sequence[str], start: str = "effective_from", end: str = "effective_to"
) -> DataFrame:
    """Versions that begin before an earlier version of the same key has ended.

    Pricing joins promise at most one match per row; that holds only if this is empty.
    The frame looks at the latest end of *all* earlier versions, so a long version that
    covers several later ones flags each of them.
    """
    w = Window.partitionBy(*keys).orderBy(start, end)
    earlier_end = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (
        df.withColumn("_earlier_end", earlier_end)
        .filter(F.col(start) <= F.col("_earlier_end"))
        .drop("_earlier_end")
    )
