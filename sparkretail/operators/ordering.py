"""Sorts, smallest keys, and reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.operators.clean import floor
from sparkretail.sources.readers import scalar

AUDIT_PREFIX = "AUDIT-"
STORE_LIST_SIZE = 12


def nulls_last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def by_amount() -> list[Column]:
    """Largest amount first, ties by event id."""
    return [F.col("amount").desc(), F.col("event_id").asc()]


def smallest_keys(df: DataFrame, key: str, n: int = STORE_LIST_SIZE) -> DataFrame:
    """The ``n`` smallest distinct keys. Distinct combines map-side; sort + limit is a
    top-n per task, not a full sort."""
    return df.select(key).distinct().orderBy(key).limit(n)


def store_list(sales: DataFrame, n: int = STORE_LIST_SIZE) -> DataFrame:
    """First stores with at least one completed in-store ticket."""
    return smallest_keys(floor(sales), "store_id", n)


def audit_seed(sales: DataFrame) -> int:
    """The largest product id among audit envelopes, one row to the driver."""
    envelopes = sales.filter(F.col("txn_id").startswith(AUDIT_PREFIX))
    seed = scalar(envelopes.agg(F.max("product_id")))
    if seed is None:
        raise ValueError("no audit envelope: the sample has no seed")
    return int(seed)


def audit_sample(sales: DataFrame, fraction: float = 0.1) -> DataFrame:
    """Seeded sample of the floor. Spark draws per partition and row position, so it
    repeats for the same files only; do not repartition or sort the input first."""
    return floor(sales).sample(False, fraction, audit_seed(sales))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Sample that depends on the key alone: same rows under any layout, in any engine.

    A row stays if the first eight hex digits of md5(seed:key) are below the fraction of
    the range; comparing the text avoids turning every digest into a number.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    if fraction == 1:
        return df
    limit = format(int(fraction * 16**8), "08x")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.filter(F.substring(digest, 1, 8) < limit)


def shuffled(df: DataFrame, seed: int = 0) -> DataFrame:
    """Random row order, so that file position says nothing about a row's version. The
    order is a hash of the row: a retried task sorts to the same place."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns))
