"""One-pass description of a data set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.cards import luhn_valid


def manifest(
    df: DataFrame,
    conditions: Mapping[str, Column] | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """Rows, rows per named condition, NULLs per column and distinct values, as
    (item, value) rows.

    All counts share one pass. Distinct values of all listed columns share a second one:
    values are stacked, de-duplicated map-side, and counted per column.
    """
    counts = {"rows": F.count(F.lit(1))}
    counts |= {name: F.count_if(cond) for name, cond in (conditions or {}).items()}
    counts |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    totals = df.agg(*[agg.alias(name) for name, agg in counts.items()])
    out = totals.unpivot([], list(counts), "item", "value")
    if not distinct:
        return out
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(f"distinct_{c}").alias("item"), F.col(c).cast("string").alias("v"))
                for c in distinct
            ]
        )
    )
    values = df.select(stacked.alias("s")).select("s.item", "s.v").distinct()
    return out.unionByName(values.groupBy("item").agg(F.count("v").alias("value")))


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def invalid_cards(payments: DataFrame, by: Sequence[str], number: str = "card_number") -> DataFrame:
    """Cards that fail their check digit, per group."""
    return payments.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cards"),
        F.count_if(~luhn_valid(number)).alias("invalid_cards"),
    )
