"""What the operators of this folder share: durable intermediate tables and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.session import shared_dir

BATCH_BYTES = 4 << 20


def durable(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared checkpoint folder.

    Later steps read the files, so lost executors cost a read and not a rerun, and a
    plan that uses the rows twice computes them once.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Rows whose labels no model may see. A row without an id has no label: false."""
    fold = F.crc32(F.col(column).cast("string")) % 5
    return F.coalesce(fold == 0, F.lit(False))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Batches that go to Python hold about ``BATCH_BYTES`` at most, for all that this
    session runs from here on. Results do not depend on it. A batch of Spark's own size, up
    to 64 MB, is held by the JVM outside its heap and again by each Python worker, and both
    keep that memory for the stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slots(spark: SparkSession) -> int:
    """Tasks that run at once."""
    return max(1, spark.sparkContext.defaultParallelism)
