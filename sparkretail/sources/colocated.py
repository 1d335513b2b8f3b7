"""Tables that are stored by the hash of their join key, so that joins need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from sparkretail.session import fresh_path


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Saves ``df`` as an external table of ``buckets`` files, each sorted by ``keys``, and
    returns it. Rows are shuffled once, here, so a bucket is one file; every later join or
    grouping on ``keys`` with a table of as many buckets reads bucket by bucket.

    A bucket holds all rows of its keys. A key with a large share of the rows belongs into
    a salted join instead.
    """
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(
        *keys
    ).saveAsTable(table)
    return df.sparkSession.table(table)


@contextmanager
def bucketed(frames: list[DataFrame], keys: list[str], buckets: int) -> Iterator[list[DataFrame]]:
    """The frames as tables of equal buckets under names of their own; the names go at the
    end of the block, so results that are to outlive it must be written in it."""
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in frames]
    spark = frames[0].sparkSession
    try:
        yield [write_bucketed(df, n, fresh_path(spark, n), keys, buckets) for df, n in zip(frames, names, strict=True)]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
