"""Writers: Parquet, small CSV/JSON results, partitioned folders, ordered exports, JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 2_000_000


def write_table(
    df: DataFrame,
    path: str,
    replace: bool = True,
    compression: str = "snappy",
    row_group_bytes: int | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Parquet sink. ``replace=False`` fails if the folder exists (Spark's default mode)."""
    writer = df.write.mode("overwrite" if replace else "errorifexists").option(
        "compression", compression
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. For results of a bounded number of groups only: a
    single task writes it. The repartition (rather than a coalesce) keeps the work
    upstream of the last task parallel."""
    df.repartition(1).write.mode("overwrite").option("header", "true").csv(path)


def write_small_json(df: DataFrame, path: str) -> None:
    """One JSON-lines file, for small results only."""
    df.repartition(1).write.mode("overwrite").json(path)


def write_partitioned(
    df: DataFrame,
    keys: list[str],
    path: str,
    max_records: int = MAX_RECORDS_PER_FILE,
    mode: str = "static",
) -> None:
    """One folder per key combination, with no more than ``max_records`` rows per file.

    Rows are shuffled on the folder keys so that a folder is not written in tiny pieces
    by every task. A folder with more rows than fit into one file is spread over as many
    tasks as it needs files, so a country that holds a third of the table does not wait
    for one writer. Folders are counted with map-side combine; only folders that need a
    split are kept, fewer than rows / ``max_records``, so the counts can be broadcast.
    """
    slots = "_slots"
    crowded = (
        df.groupBy(*keys)
        .count()
        .filter(F.col("count") > max_records)
        .select(*keys, F.ceil(F.col("count") / max_records).cast("int").alias(slots))
    )
    right = crowded.select(*[F.col(k).alias(f"_k_{k}") for k in keys], slots)
    same_folder = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same_folder = eq if same_folder is None else same_folder & eq
    staged = (
        df.withColumn("_row", F.xxhash64(*df.columns))
        .join(F.broadcast(right), same_folder, "left")
        .withColumn("_slot", F.pmod(F.col("_row"), F.coalesce(F.col(slots), F.lit(1))))
        .repartition(*keys, "_slot")
        .select(*df.columns)
    )
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*keys)
        .parquet(path)
    )


def overwrite_partitions(
    df: DataFrame, keys: list[str], path: str, max_records: int = MAX_RECORDS_PER_FILE
) -> None:
    """Replaces the folders of the key combinations in ``df`` and leaves all others, files
    and times, as they are. Repeating the write changes nothing, so a job that was cut off
    is simply run again. ``df`` must not read the folders it replaces."""
    write_partitioned(df, keys, path, max_records, mode="dynamic")


def write_sorted(df: DataFrame, order: list[Column], n_files: int, path: str) -> None:
    """Globally ordered export as ``n_files`` range-ordered part files.

    Reading the parts in name order gives the total order. Each task sorts only its own
    range and may spill; nothing gathers the rows into one list. Include a unique column
    in ``order``: ranges are cut on the whole key, so a frequent leading value is split.
    """
    df.repartitionByRange(n_files, *order).sortWithinPartitions(*order).write.mode(
        "overwrite"
    ).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    batch_size: int = 10_000,
    connections: int = 8,
) -> dict[str, str]:
    """Options of the JDBC sink; ``connections`` bounds the parallel writers."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        "truncate": "true",
    }


def write_jdbc(df: DataFrame, options: dict[str, str], replace: bool = True) -> None:
    df.write.format("jdbc").options(**options).mode("overwrite" if replace else "append").save()
