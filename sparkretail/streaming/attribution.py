"""Stream-stream attribution: impressions joined to the purchases that follow them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.operators.compare import row_diff
from sparkretail.session import conf_overlay
from sparkretail.sources.sinks import write_table

WATERMARK = "2 minutes"
WINDOW_SECONDS = 600
OUTPUT = ("impression_id", "purchase_id", "visitor_id", "campaign_id", "product_id", "amount")


def attribute(
    impressions: DataFrame,
    purchases: DataFrame,
    watermark: str = WATERMARK,
    window_seconds: int = WINDOW_SECONDS,
    output: Sequence[str] = OUTPUT,
) -> DataFrame:
    """Every (impression, purchase) pair of one visitor with the purchase 0 to
    ``window_seconds`` after the impression.

    The time range is part of the join condition, which together with the watermarks
    bounds the state: Spark drops impressions and purchases that can no longer meet a
    partner, and rows that arrive behind the watermark. Late means behind the *global*
    watermark as it stood after the batch before. The event-time columns must be
    TIMESTAMP.
    """
    i = impressions.withWatermark("impression_ts", watermark).alias("i")
    p = purchases.withWatermark("purchase_ts", watermark).alias("p")
    pairs = i.join(
        p,
        (F.col("i.visitor_id") == F.col("p.visitor_id"))
        & (F.col("p.purchase_ts") >= F.col("i.impression_ts"))
        & (
            F.col("p.purchase_ts")
            <= F.col("i.impression_ts") + F.expr(f"INTERVAL {int(window_seconds)} SECONDS")
        ),
    )
    left = set(impressions.columns)
    return pairs.select(*[F.col(f"{'i' if c in left else 'p'}.{c}").alias(c) for c in output])


def drain_to_files(
    stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None
) -> None:
    """Process the whole backlog, append the result to Parquet, and return.

    The number of state partitions is fixed for the life of a checkpoint; it defaults to
    the session's shuffle partitions. Restarting with the same checkpoint continues
    where the last run stopped, also after lost executors.
    """
    spark = stream.sparkSession
    conf = {}
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with conf_overlay(spark, conf):
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def write_slices(
    df: DataFrame, slice_column: str, n_slices: int, path: str, files_per_slice: int = 1, append: bool = False
) -> None:
    """Write rows as ``files_per_slice`` files per slice, slice after slice.

    A file stream orders its input by modification time, so the slices have to be written
    one after another. With ``files_per_slice`` files per trigger one micro-batch is one
    slice, however many tasks wrote it. ``append`` goes on in a folder that has slices.
    """
    for n in range(n_slices):
        part = df.filter(F.col(slice_column) == n).drop(slice_column).repartition(files_per_slice)
        if n == 0 and not append:
            write_table(part, path)
        else:
            part.write.mode("append").parquet(path)


def stream_batch_difference(batch_pairs: DataFrame, stream_pairs: DataFrame) -> DataFrame:
    """Pairs the batch join finds and the stream does not (positive surplus): exactly the
    pairs of late rows. Empty on a drop without late rows."""
    return row_diff(batch_pairs, stream_pairs)
