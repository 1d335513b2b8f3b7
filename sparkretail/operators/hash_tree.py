"""Differences of two large, nearly equal tables by a tree of hash sums.

Rows are hashed into buckets by their key; a bucket is summed up by the hashes of its rows,
added for one side and taken off for the other, so equal content gives zero whatever its
order. Only buckets that are not zero are looked into: first as smaller buckets, then row by
row. Equal tables cost one aggregate that combines map-side; nothing is sorted or shuffled
as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE, FINE = 1 << 10, 1 << 20  # buckets of the two levels; the fine ones fit a broadcast
_LOW = (1 << 32) - 1


def _sums() -> list[Column]:
    """Rows of one side less those of the other, and the halves of their hashes likewise.
    In 64 bits they hold for some thousand million rows a bucket."""
    return [
        F.sum(F.col("_side")).alias("_rows"),
        F.sum(F.col("_side") * F.col("_hash").bitwiseAND(F.lit(_LOW))).alias("_one"),
        F.sum(F.col("_side") * F.shiftrightunsigned("_hash", 32)).alias("_two"),
    ]


_DIFFERENT = "_rows <> 0 OR _one <> 0 OR _two <> 0"


def tree_diff(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    absolute: Mapping[str, float] | None = None,
    relative: Mapping[str, float] | None = None,
) -> DataFrame:
    """(keys, verdict, columns) for every key on which the tables differ: ``missing``,
    ``extra``, ``duplicate`` (one side has several rows, and not the same ones as the other)
    or ``mismatch``, with the names of the differing columns, joined by commas.

    Columns are compared by name; those that only one side has are an error. ``absolute``
    and ``relative`` are tolerances of numeric columns; differences within them are none. A
    null equals a null, in keys too. Equal duplicates on both sides are no difference. Two
    rows of equal 64-bit hash count as equal; for a thousand million differing rows that is
    one chance in ten thousand million.
    """
    if set(expected.columns) != set(actual.columns):
        raise ValueError(f"columns differ: {sorted(set(expected.columns) ^ set(actual.columns))}")
    absolute, relative = dict(absolute or {}), dict(relative or {})
    values = [c for c in expected.columns if c not in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        # The type is part of neither hash: both sides have the types of the expected one.
        typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in expected.schema.fields))
        key = F.xxhash64(*keys)
        return typed.select(
            *keys, F.struct(*values).alias("_values"), F.lit(sign).cast("bigint").alias("_side"),
            F.xxhash64(*keys, *values).alias("_hash"),
            F.pmod(key, F.lit(COARSE)).cast("int").alias("_coarse"), F.pmod(key, F.lit(FINE)).cast("int").alias("_fine"),
        )

    both = side(expected, 1).unionByName(side(actual, -1))
    coarse = [r[0] for r in both.groupBy("_coarse").agg(*_sums()).where(_DIFFERENT).select("_coarse").collect()]
    inside = both.where(F.col("_coarse").isin(coarse) if coarse else F.lit(False))
    fine = inside.groupBy("_fine").agg(*_sums()).where(_DIFFERENT).select("_fine")
    rows = inside.join(F.broadcast(fine), "_fine", "left_semi")
    here, there = F.col("_side") == 1, F.col("_side") == -1
    found = rows.groupBy(*keys).agg(
        *_sums(),
        F.count_if(here).alias("_n"), F.count_if(there).alias("_m"),
        F.max(F.when(here, F.col("_values"))).alias("_a"), F.max(F.when(there, F.col("_values"))).alias("_b"),
    ).where(_DIFFERENT)

    def differs(name: str) -> Column:
        a, b = F.col("_a")[name], F.col("_b")[name]
        other = ~a.eqNullSafe(b)
        if name in absolute or name in relative:
            room = F.greatest(F.lit(absolute.get(name, 0.0)), F.lit(relative.get(name, 0.0)) * F.abs(a.cast("double")))
            other &= F.coalesce(F.abs(a.cast("double") - b.cast("double")) > room, F.lit(True))
        return other

    names = F.array_compact(F.array(*[F.when(differs(v), F.lit(v)) for v in values])) if values else F.array().cast("array<string>")
    verdict = (
        F.when(F.col("_m") == 0, "missing").when(F.col("_n") == 0, "extra")
        .when((F.col("_n") > 1) | (F.col("_m") > 1), "duplicate").otherwise("mismatch")
    )
    return (
        found.select(*keys, verdict.alias("verdict"), F.array_join(names, ",").alias("columns"))
        .withColumn("columns", F.when(F.col("verdict") == "mismatch", F.col("columns")).otherwise(F.lit("")))
        .where("verdict <> 'mismatch' OR columns <> ''")
    )
