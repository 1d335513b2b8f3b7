"""Comparing two tables. One grouped pass instead of a join.

Both sides are tagged and stacked, then grouped on the key. The grouping combines
map-side, so duplicate keys collapse before the shuffle and never multiply, and NULL
keys compare equal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

EXAMPLES = 5


@dataclass(frozen=True)
class Tolerance:
    """How far two values may differ, per column. Everything else must be equal."""

    absolute: Mapping[str, float] = field(default_factory=dict)
    relative: Mapping[str, float] = field(default_factory=dict)  # of the expected value
    as_set: Sequence[str] = ()  # arrays whose order and repetitions do not matter


def schema_problems(expected: DataFrame, actual: DataFrame, types: bool = True) -> list[str]:
    """Differences in column names, order and (optionally) types; empty when equal."""
    problems = []
    if expected.columns != actual.columns:
        problems.append(f"columns: expected {expected.columns}, got {actual.columns}")
    elif types:
        for e, a in zip(expected.schema, actual.schema):
            if e.dataType != a.dataType:
                problems.append(
                    f"{e.name}: expected {e.dataType.simpleString()}, got {a.dataType.simpleString()}"
                )
    return problems


def concat_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack parts of one table; parts with other columns are refused."""
    for part in parts[1:]:
        problems = schema_problems(parts[0], part)
        if problems:
            raise ValueError("; ".join(problems))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _differs(name: str, expected: Column, actual: Column, tol: Tolerance) -> Column:
    if name in tol.absolute:
        far = F.abs(expected.cast("double") - actual.cast("double")) > tol.absolute[name] + 1e-9
    elif name in tol.relative:
        far = F.abs(actual.cast("double") - expected.cast("double")) > F.lit(
            tol.relative[name]
        ) * F.abs(expected.cast("double"))
    else:
        return ~expected.eqNullSafe(actual)
    # A value against a NULL is a difference, NULL against NULL is not.
    return F.coalesce(far, ~(expected.isNull() & actual.isNull()))


def keyed_diff(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    tolerance: Tolerance = Tolerance(),
) -> DataFrame:
    """One row per key: ``verdict`` and the names of the differing columns.

    Verdicts: equal, mismatch, missing (expected only), extra (actual only), duplicate
    (the key occurs more than once on a side).
    """
    values = [c for c in expected.columns if c not in keys]

    def tagged(df: DataFrame, side: int) -> DataFrame:
        def value(c: str) -> Column:
            as_set = c in tolerance.as_set and isinstance(df.schema[c].dataType, ArrayType)
            return (F.array_sort(F.array_distinct(c)) if as_set else F.col(c)).alias(c)

        return df.select(*keys, F.lit(side).alias("_side"), F.struct(*[value(c) for c in values]).alias("_v"))

    def of(side: int, what: Column) -> Column:
        return F.when(F.col("_side") == side, what)

    if not values:
        raise ValueError("nothing to compare besides the keys, use key_diff")
    grouped = (
        tagged(expected, 0)
        .unionByName(tagged(actual, 1))
        .groupBy(*keys)
        .agg(
            F.count(of(0, F.lit(1))).alias("expected_rows"),
            F.count(of(1, F.lit(1))).alias("actual_rows"),
            F.min(of(0, F.col("_v"))).alias("_e"),
            F.min(of(1, F.col("_v"))).alias("_a"),
        )
    )
    differing = F.filter(
        F.array(
            *[
                F.when(_differs(c, F.col(f"_e.{c}"), F.col(f"_a.{c}"), tolerance), F.lit(c))
                for c in values
            ]
        ),
        lambda c: c.isNotNull(),
    )
    verdict = (
        F.when((F.col("expected_rows") > 1) | (F.col("actual_rows") > 1), "duplicate")
        .when(F.col("actual_rows") == 0, "missing")
        .when(F.col("expected_rows") == 0, "extra")
        .when(F.size("_diff") > 0, "mismatch")
        .otherwise("equal")
    )
    return grouped.withColumn("_diff", differing).select(
        *keys,
        verdict.alias("verdict"),
        F.when(verdict == "mismatch", F.col("_diff")).otherwise(F.array().cast("array<string>")).alias("columns"),
        "expected_rows",
        "actual_rows",
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    """Number of keys per verdict."""
    return diff.groupBy("verdict").agg(F.count(F.lit(1)).alias("n_keys"))


def diff_examples(diff: DataFrame, keys: Sequence[str], n: int = EXAMPLES) -> DataFrame:
    """The first few keys that are not equal."""
    return diff.filter(F.col("verdict") != "equal").orderBy(*keys).limit(n)


def key_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, with the side's verdict (missing or extra)."""
    both = (
        expected.select(*keys, F.lit(0).alias("_side"))
        .unionByName(actual.select(*keys, F.lit(1).alias("_side")))
        .groupBy(*keys)
        .agg(F.min("_side").alias("lo"), F.max("_side").alias("hi"))
    )
    return both.filter(F.col("lo") == F.col("hi")).select(
        *keys, F.when(F.col("lo") == 0, "missing").otherwise("extra").alias("verdict")
    )


def row_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Whole-row comparison with multiplicity, for tables without a key: rows whose
    number of copies differs, with the surplus (positive: missing in actual)."""
    return (
        expected.withColumn("_n", F.lit(1))
        .unionByName(actual.withColumn("_n", F.lit(-1)))
        .groupBy(*expected.columns)
        .agg(F.sum("_n").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def same_rows(expected: DataFrame, actual: DataFrame) -> bool:
    return row_diff(expected, actual).isEmpty()


def floor_versus_lake(lake: DataFrame, floor: DataFrame, key: str) -> DataFrame:
    """Keys that exist in the raw table but not in the filtered population: non-empty
    means that a distinct before the filter would give a different list."""
    return key_diff(lake, floor, [key]).filter(F.col("verdict") == "missing").select(key)
