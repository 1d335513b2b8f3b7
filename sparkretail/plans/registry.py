"""All registered queries and the SQL that states the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
)

from sparkretail.plans import click_queries, payment_queries, sales_queries, table_queries
from sparkretail.session import pin_utc

_MODULES = (sales_queries, payment_queries, click_queries, table_queries)

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Types that mean the same in every engine: decimals as doubles, whole numbers as
    bigint, dates and sets as text. Operators return their contract types; only the
    result handed to a comparison is converted."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType, BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return comparable(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _registered(q) for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
