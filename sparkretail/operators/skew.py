"""Joins whose cost does not depend on one key holding a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from sparkretail.sources.readers import scalar

# Payload up to this size may be broadcast. Spark's own limit for a hash relation is
# 8 GB; a small fraction of executor memory keeps room for the tasks themselves.
BROADCAST_BYTES = 128 * 1024 * 1024
# Rows of one key that a single task may hold; a key with more is split into as many
# parts as it needs.
ROWS_PER_TASK = 2_000_000
# Parts of every key in the plans that salt uniformly, where nothing is counted.
BUCKETS = 16

_SALT = "_salt"


def payload_bytes(df: DataFrame) -> int:
    """Measured size of the data: string and binary lengths plus fixed-width columns."""
    fixed, measured = 0, []
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            measured.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + 8)
        else:
            fixed += 16
    row = reduce(lambda a, b: a + b, measured, F.lit(fixed)).cast("bigint")
    return scalar(df.agg(F.coalesce(F.sum(row), F.lit(0))))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Run one aggregate over ``df`` and say whether it may be broadcast."""
    return payload_bytes(df) <= max_bytes


def salt_of(column: Column | str, buckets: int = BUCKETS) -> Column:
    """Salt from a row id: a pure function of the row, never ``rand()``, so a retried
    task puts every row back into the bucket it had before."""
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(column.cast("binary")), F.lit(buckets)).cast("int")


def salt_of_row(columns: list[str], buckets: int = BUCKETS) -> Column:
    """Salt from the whole row, for tables without a row id."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def replicate(df: DataFrame, buckets: int = BUCKETS, name: str = _SALT) -> DataFrame:
    """One copy of every row per salt bucket."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the ``parts`` they need.

    At most rows / ``rows_per_task`` keys. Counting combines map-side, so a hot key
    shuffles one row per task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    return counts.select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("parts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hint: str | None = None,
) -> DataFrame:
    """Equi-join that cuts every key of ``left`` with more than ``rows_per_task`` rows.

    The keys are counted at once, by a job of their own: there are at most rows /
    ``rows_per_task`` of them, and both sides need them. ``hint`` is the join hint of the
    right side.

    Each such key gets as many salts as it needs; rows of other keys keep salt 0, and the
    right side is copied for hot keys only. ``how`` is inner, left, left_semi or left_anti.
    Rows with a NULL key match nothing; they are spread over all tasks.
    """
    counted = hot_keys(left.dropna(subset=keys), keys, rows_per_task).withColumnRenamed("parts", "_parts")
    found = counted.collect()
    hinted = (lambda df: df.hint(hint)) if hint else (lambda df: df)
    if not found and how in ("inner", "left_semi"):  # no row with a null key is kept
        return left.join(hinted(right), keys, how)
    parts = left.sparkSession.createDataFrame(found, counted.schema)
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    row = F.xxhash64(*left.columns)
    salt = F.when(has_null, F.pmod(row, F.lit(2**31 - 1)).cast("int")).otherwise(
        F.coalesce(F.pmod(row, F.col("_parts")).cast("int"), F.lit(0))
    )
    left_salted = left.join(F.broadcast(parts), keys, "left").withColumn(_SALT, salt).select(*left.columns, _SALT)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    right_salted = (
        right.join(F.broadcast(parts), keys, "left")
        .withColumn(_SALT, F.explode(copies))
        .select(*right.columns, _SALT)
    )
    return left_salted.join(hinted(right_salted), [*keys, _SALT], how).drop(_SALT)


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large left side to a side of unknown size.

    The right side is measured. Small enough: it is broadcast and the left side is not
    shuffled at all, whatever its key distribution. Otherwise: ``salted_join``.
    """
    if fits_broadcast(right, max_bytes):
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how)
