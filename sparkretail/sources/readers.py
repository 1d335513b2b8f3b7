"""Scans: Parquet folders, paired inputs, JSON results, file streams, object stores."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet folder (one or many parts); the schema comes from the footers."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_pair(spark: SparkSession, fact: str, dim: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, fact), read_table(spark, dim)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines. Pass a schema for large inputs, inference reads the data once more."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    files_per_trigger: int = 1,
    pattern: str = "part-*.parquet",
) -> DataFrame:
    """Parquet files as a stream, oldest first, a fixed number per micro-batch.

    The source orders files by modification time, so they must be written in event-time
    order.
    """
    return (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", pattern)
        .option("latestFirst", "false")
        .load(path)
    )


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True, tls: bool = False
) -> dict[str, str]:
    """Session settings for ``s3a://`` paths on an S3-compatible store."""
    prefix = "spark.hadoop.fs.s3a."
    return {
        f"{prefix}impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        f"{prefix}endpoint": endpoint,
        f"{prefix}access.key": access_key,
        f"{prefix}secret.key": secret_key,
        f"{prefix}path.style.access": str(path_style).lower(),
        f"{prefix}connection.ssl.enabled": str(tls).lower(),
    }


def scalar(df: DataFrame):
    """The value of a one-row, one-column aggregate (a seed, a check total)."""
    return df.first()[0]


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()
