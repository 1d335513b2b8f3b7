"""Valid rows and quarantined rows in one pass, with the rules that each row breaks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

MOST_RULES = 63


def with_faults(df: DataFrame, rules: Mapping[str, Column], name: str = "faults") -> DataFrame:
    """``df`` with a number whose bit i is set if the row breaks the i-th rule. A rule that
    is unknown because of a null is broken."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    if name in df.columns:
        raise ValueError(f"column {name!r} exists already")
    bits = F.lit(0).cast("bigint")
    for i, holds in enumerate(rules.values()):
        bits += F.when(F.coalesce(holds, F.lit(False)), F.lit(0)).otherwise(F.lit(1 << i)).cast("bigint")
    return df.withColumn(name, bits)


def broken_rules(rules: Mapping[str, Column], name: str = "faults") -> Column:
    """The names of the rules whose bits are set, in their order."""
    names = F.array(*[F.when(F.col(name).bitwiseAND(F.lit(1 << i)) != 0, F.lit(rule)) for i, rule in enumerate(rules)])
    return F.array_compact(names)


def split_valid(df: DataFrame, rules: Mapping[str, Column], path: str) -> dict[str, int]:
    """Writes the rows of ``df`` below ``path`` in one job: ``valid=true`` holds rows that
    keep all rules, ``valid=false`` the others, with the rules they break in ``faults``.
    Returns the number of rows, of valid rows, and of rows that break each rule, counted
    on the way by the same job.
    """
    marked = with_faults(df, rules)
    seen = Observation()
    counts = [F.count_if(F.col("faults").bitwiseAND(F.lit(1 << i)) != 0).alias(rule) for i, rule in enumerate(rules)]
    marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("faults") == 0).alias("valid_rows"), *counts
    ).withColumn("valid", F.col("faults") == 0).write.mode("overwrite").partitionBy("valid").parquet(path)
    return dict(seen.get)


def _written(df: DataFrame, path: str) -> DataFrame:
    fields = [*df.schema.fields, StructField("faults", LongType()), StructField("valid", BooleanType())]
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)


def valid_rows(df: DataFrame, path: str) -> DataFrame:
    """The valid rows that ``split_valid`` wrote, with the columns of its input ``df``."""
    return _written(df, path).where("valid").select(*df.columns)


def quarantined_rows(df: DataFrame, path: str, rules: Mapping[str, Column]) -> DataFrame:
    """The other rows, with ``broken``, the names of the rules they break."""
    return _written(df, path).where("NOT valid").select(*df.columns, broken_rules(rules).alias("broken"))
