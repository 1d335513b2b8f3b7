"""Fewer, larger files for the folders of a partitioned table that hold many small ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.operators.running import running
from sparkretail.operators.skew import fits_broadcast
from sparkretail.session import conf_overlay, fresh_path

TARGET_BYTES = 256 << 20
FULL = 0.75  # a file of this share of the target is left alone


def file_sizes(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file of a table that is read from files: its folder keys, path, bytes and
    rows. No data column is read."""
    return (
        table.select(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy(*keys, "file").agg(F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )


def packed(files: DataFrame, keys: Sequence[str], target: int) -> DataFrame:
    """``files`` of the folders worth rewriting, with ``bin``, the new file that takes each.

    A folder is rewritten if it would have fewer files. A full file stays a bin of its own;
    the others, in the order of their paths, fill a bin until it holds the target. The
    running sums are those of ``running``, so a folder with very many files is no single task.
    """
    small = files.withColumn("small", F.col("bytes") < target * FULL).withColumn(
        "small_bytes", F.when(F.col("small"), F.col("bytes")).otherwise(0)
    )
    summed = running(small, keys, ["file"], {"through": "small_bytes"}, "number")
    # Bins are cut where the bytes before a file pass a multiple of the target.
    before = F.floor((F.col("through") - F.col("small_bytes")) / target)
    placed = summed.withColumn("bin", F.when(F.col("small"), before).otherwise(-F.col("number")))
    gain = placed.groupBy(*(F.col(k).alias(f"_of_{k}") for k in keys)).agg(
        F.count(F.lit(1)).alias("_files"), F.count_distinct("bin").alias("_bins")
    ).where("_bins < _files")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(gain, same, "left_semi").select(*keys, "file", "bytes", "rows", "bin")


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: int = TARGET_BYTES) -> DataFrame:
    """Rewrites the folders of the Parquet table at ``path`` that have files to spare and
    returns what was rewritten: file, bytes and bin of each old file.

    Rows keep their folder. Each bin is one task and one file. The new content is written
    apart and then replaces these folders only, so a run that fails midway is repeated with
    the same rows. Folders whose files are large enough are neither read nor written.
    """
    table = spark.read.parquet(path)
    columns = table.columns
    plan_path, staged = fresh_path(spark, "compaction-plan"), fresh_path(spark, "compaction")
    sizes_path = fresh_path(spark, "file-sizes")
    file_sizes(table, keys).write.parquet(sizes_path)
    packed(spark.read.parquet(sizes_path), keys, target).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    bins = plan.select("file", "bin")
    bins = F.broadcast(bins) if fits_broadcast(bins) else bins
    rows = table.withColumn("file", F.col("_metadata.file_path")).join(bins, "file").select(*columns, "bin")
    rows.write.parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged)
    with conf_overlay(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        again.repartition(*keys, "bin").sortWithinPartitions(*keys, "bin").drop("bin").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*keys).parquet(path)
    return plan
