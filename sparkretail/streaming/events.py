"""Event streams: counts per time window, and rows that arrive more than once."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.session import conf_overlay


def windowed_totals(
    events: DataFrame,
    time: str,
    keys: Sequence[str],
    width: str,
    watermark: str,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows and sums per key and time window, each window once, when it is closed.

    A window is closed, and its state dropped, once the watermark has passed its end; rows
    that arrive for it later are dropped. State holds the open windows only, whatever the
    length of the stream. Counts are combined before the shuffle, so a frequent key sends
    one row per task and window.
    """
    window = F.window(F.col(time), width)
    return (
        events.withWatermark(time, watermark)
        .groupBy(window.alias("_window"), *keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), *(F.sum(c).alias(n) for n, c in (sums or {}).items()))
        .select("_window.start", "_window.end", *keys, "n_rows", *(sums or {}))
    )


def first_arrivals(events: DataFrame, time: str, keys: Sequence[str], watermark: str) -> DataFrame:
    """The first of all rows with the same ``keys`` that arrive within ``watermark`` of each
    other in event time. Keys are forgotten once the watermark has passed their time by
    that much; a row behind the watermark is dropped."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(keys))


def drain(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> list[dict]:
    """Processes what has arrived, appends the results to Parquet, stops, and returns the
    progress of each micro-batch.

    Called again with the same ``checkpoint`` it goes on behind the last finished batch
    with the state of that batch. A batch that was cut off is done again; the Parquet sink
    keeps a log of finished batches, so its rows are not there twice.
    """
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with conf_overlay(stream.sparkSession, conf):
        query = (
            stream.writeStream.format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]
