"""Keyed merges of change sets into a table that keeps the latest row or all versions.

A versioned table has one row per key and interval: its values, ``valid_from``,
``valid_to`` (null: still valid) and ``bucket``, a hash of the key that is the table's
folder. A merge reads and rewrites only the buckets that the change set touches; other
folders are neither read nor written. The chain of a key is rebuilt from its events, old
and new, in the order of their times, so late changes find their place, and merging the
same change set again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.operators.running import running
from sparkretail.session import fresh_path
from sparkretail.sources.sinks import overwrite_partitions, write_partitioned

BUCKETS = 64
GONE = "deleted"  # in a change set: the key ends at this time


@dataclass(frozen=True)
class Layout:
    """What a versioned table is made of.

    ``tracked`` columns make a new version when they change (type 2); ``latest`` columns
    hold the newest value in every version of a key (type 1). ``at`` is the time column of
    a change set.
    """

    keys: Sequence[str]
    tracked: Sequence[str]
    latest: Sequence[str] = ()
    at: str = "changed_at"
    buckets: int = BUCKETS

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.tracked, *self.latest]

    @property
    def table_columns(self) -> list[str]:
        """Columns of the table, its folder last, where Spark puts it when it reads."""
        return [*self.columns, "latest_at", "valid_from", "valid_to", "bucket"]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")


def row_hash(columns: Sequence[str]) -> Column:
    """One value for what the columns hold. Each is written with its length and nulls apart,
    so no two rows share a text."""
    parts = [
        F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
        for c in columns
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def _one_per_time(events: DataFrame, layout: Layout) -> DataFrame:
    """One event per key and time. The change set wins over the table (``_new``), then a
    deletion over a value, then the greatest values, so repeated rows and ties have one
    outcome. The aggregate combines map-side."""
    rank = F.struct("_new", F.coalesce(GONE, F.lit(False)).alias(GONE), *layout.tracked)
    best = events.groupBy(*layout.keys, layout.at).agg(F.max(rank).alias("_best"))
    return best.select(*layout.keys, layout.at, *(F.col("_best")[c].alias(c) for c in (GONE, *layout.tracked)))


def chains(events: DataFrame, layout: Layout, rows_per_task: int | None = None) -> DataFrame:
    """Versions of all keys from their events (keys, time, values, deleted).

    Events that repeat what the one before them says are dropped; of what remains, each is
    valid until the next begins, and deletions only end what came before. Type 1 columns
    are those of a key's latest event that is no deletion (``latest_at``). A key with very
    many events is worked off in pieces. Null keys are keys; events without a time are
    ignored. A table keeps versions, not events: a change that repeated the version before
    it leaves no trace there, also if a later merge puts another value between the two.
    """
    events = events.where(F.col(layout.at).isNotNull())
    one = _one_per_time(events, layout)
    marked = one.withColumn("_hash", F.when(F.col(GONE), F.lit("gone")).otherwise(row_hash(layout.tracked)))
    order, spark = [layout.at], events.sparkSession
    marked = _written(spark, marked)
    seen = running(marked, layout.keys, order, previous={"_hash_before": "_hash"}, rows_per_task=rows_per_task)
    before = F.col("_hash_before")
    # An end that follows nothing or an end says nothing; nor does a value that repeats.
    changed = seen.where(F.coalesce(F.col("_hash") != before, ~F.col(GONE))).drop("_hash_before")
    versions = running(_written(spark, changed), layout.keys, order, following={"valid_to": layout.at}, rows_per_task=rows_per_task)
    newest = events.where(~F.coalesce(GONE, F.lit(False))).groupBy(*(F.col(k).alias(f"_of_{k}") for k in layout.keys)).agg(
        F.max(F.struct("latest_at", "_new", *layout.latest)).alias("_latest")
    )
    return (
        versions.where(~F.col(GONE)).join(newest, _same(layout))
        .withColumn("bucket", layout.bucket()).withColumn("valid_from", F.col(layout.at))
        .select(
            *layout.keys, *layout.tracked, *(F.col("_latest")[c].alias(c) for c in (*layout.latest, "latest_at")),
            "valid_from", "valid_to", "bucket",
        )
    )


def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The same rows from files: ``running`` reads them several times."""
    path = fresh_path(spark, "chains")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _same(layout: Layout) -> Column:
    found = F.lit(True)
    for k in layout.keys:
        found &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return found


def _as_events(versions: DataFrame, layout: Layout) -> DataFrame:
    """The events that a versioned table came from: beginnings, and ends that no version
    follows."""
    begins = versions.select(*layout.columns, "latest_at", F.col("valid_from").alias(layout.at), F.lit(False).alias(GONE))
    starts = versions.select(*(F.col(k).alias(f"_of_{k}") for k in layout.keys), F.col("valid_from").alias("_start"))
    ends = versions.where(F.col("valid_to").isNotNull()).join(
        starts, (F.col("valid_to") == F.col("_start")) & _same(layout), "left_anti"
    )
    ends = ends.select(*layout.columns, "latest_at", F.col("valid_to").alias(layout.at), F.lit(True).alias(GONE))
    return begins.unionByName(ends).withColumn("_new", F.lit(0))


def _new_events(changes: DataFrame, layout: Layout) -> DataFrame:
    at = F.col(layout.at)
    return changes.select(*layout.columns, at.alias("latest_at"), at, GONE, F.lit(1).alias("_new"))


def create(changes: DataFrame, path: str, layout: Layout, rows_per_task: int | None = None) -> None:
    """Writes the versioned table of a first change set."""
    write_partitioned(chains(_new_events(changes, layout), layout, rows_per_task), ["bucket"], path)


def merge(spark: SparkSession, path: str, changes: DataFrame, layout: Layout, rows_per_task: int | None = None) -> list[int]:
    """Merges a change set (keys, values, time, ``deleted``) into the table at ``path`` and
    returns the buckets that were rewritten.

    The new content of the touched buckets is written apart first and then replaces their
    folders, so a run that fails midway is repeated with the same outcome.
    """
    events = _new_events(changes, layout)
    touched = [r[0] for r in events.select(layout.bucket()).distinct().collect()]  # at most ``buckets`` numbers
    table = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    staged = fresh_path(spark, "merge")
    chains(_as_events(table, layout).unionByName(events), layout, rows_per_task).write.parquet(staged)
    overwrite_partitions(spark.read.parquet(staged), ["bucket"], path)
    return sorted(touched)


def upsert(spark: SparkSession, path: str, changes: DataFrame, layout: Layout) -> list[int]:
    """Type 1 merge: the table at ``path`` holds one row per key, its latest (keys, values,
    time, bucket). A change older than what the table holds is ignored; a deletion removes
    the row. Returns the buckets that were rewritten."""
    rows = changes.select(*layout.columns, layout.at, GONE, layout.bucket(), F.lit(1).alias("_new"))
    touched = [r[0] for r in rows.select("bucket").distinct().collect()]
    table = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    old = table.select(*layout.columns, layout.at, GONE, "bucket", F.lit(0).alias("_new"))
    values = [*layout.tracked, *layout.latest]
    rank = F.struct(layout.at, "_new", F.coalesce(GONE, F.lit(False)).alias(GONE), *values)
    best = old.unionByName(rows).groupBy(*layout.keys, "bucket").agg(F.max(rank).alias("_best"))
    # Deleted keys stay as marked rows, so that an older change cannot bring them back.
    kept = best.select(*layout.keys, *(F.col("_best")[c].alias(c) for c in (*values, layout.at, GONE)), "bucket")
    staged = fresh_path(spark, "upsert")
    kept.write.parquet(staged)
    overwrite_partitions(spark.read.parquet(staged), ["bucket"], path)
    return sorted(touched)


def create_latest(changes: DataFrame, path: str, layout: Layout) -> None:
    """Writes the one-row-per-key table of a first change set, for ``upsert``."""
    rank = F.struct(layout.at, F.coalesce(GONE, F.lit(False)).alias(GONE), *layout.tracked, *layout.latest)
    best = changes.groupBy(*layout.keys).agg(F.max(rank).alias("_best"))
    names = [*layout.tracked, *layout.latest, layout.at, GONE]
    rows = best.select(*layout.keys, *(F.col("_best")[c].alias(c) for c in names)).withColumn("bucket", layout.bucket())
    write_partitioned(rows, ["bucket"], path)


def live(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The rows of an ``upsert`` table that are not deleted."""
    return spark.read.parquet(path).where(~F.col(GONE)).select(*layout.columns, layout.at)
