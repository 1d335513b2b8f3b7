"""Skew metrics from Spark event logs.

An event log is one JSON object per line. The schema below names only the fields the
metrics need, so the scan neither infers a schema nor parses the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkretail.sources.readers import read_json

QUANTILES = [0.0, 0.5, 0.75, 0.95, 1.0]
MIN_TASKS = 4
MIN_TASK_SECONDS = 0.001

EVENT_SCHEMA = """
    `Event` STRING,
    `App ID` STRING,
    `Timestamp` BIGINT,
    `Stage ID` INT,
    `Stage Info` STRUCT<`Stage ID`: INT, `Stage Name`: STRING, `Number of Tasks`: INT,
                        `Submission Time`: BIGINT, `Completion Time`: BIGINT>,
    `Task Info` STRUCT<`Launch Time`: BIGINT, `Finish Time`: BIGINT, `Failed`: BOOLEAN>,
    `Task Metrics` STRUCT<`Executor Run Time`: BIGINT, `Disk Bytes Spilled`: BIGINT,
                          `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: BIGINT,
                                                         `Local Bytes Read`: BIGINT,
                                                         `Total Records Read`: BIGINT>>
"""


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Log file, rolled log folder or a folder of many logs; ``log`` names the run.

    Rolled logs keep their parts in one folder per application, so the run is the folder
    there and the file otherwise.
    """
    folder = F.regexp_extract(F.input_file_name(), r"(eventlog_v2_[^/]+)/[^/]+$", 1)
    file = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    events = read_json(spark, path, EVENT_SCHEMA)
    return events.withColumn("log", F.when(folder != "", folder).otherwise(file))


def stages(events: DataFrame) -> DataFrame:
    """Completed stages with their wall time."""
    info = F.col("Stage Info")
    millis = info["Completion Time"] - info["Submission Time"]
    return events.filter(F.col("Event") == "SparkListenerStageCompleted").select(
        "log",
        info["Stage ID"].alias("stage_id"),
        info["Stage Name"].alias("stage_name"),
        info["Number of Tasks"].alias("tasks"),
        F.greatest(F.lit(0.0), millis / 1000).alias("stage_seconds"),
    )


def tasks(events: DataFrame) -> DataFrame:
    """Finished tasks with duration, run time, shuffle read and spill."""
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    shuffle = metrics["Shuffle Read Metrics"]
    return events.filter(F.col("Event") == "SparkListenerTaskEnd").select(
        "log",
        F.col("Stage ID").alias("stage_id"),
        F.greatest(F.lit(0.0), (info["Finish Time"] - info["Launch Time"]) / 1000).alias("seconds"),
        F.coalesce(metrics["Executor Run Time"], F.lit(0)).alias("run_ms"),
        (
            F.coalesce(shuffle["Remote Bytes Read"], F.lit(0))
            + F.coalesce(shuffle["Local Bytes Read"], F.lit(0))
        ).alias("shuffle_bytes"),
        F.coalesce(shuffle["Total Records Read"], F.lit(0)).alias("shuffle_records"),
        F.coalesce(metrics["Disk Bytes Spilled"], F.lit(0)).alias("spill_bytes"),
    )


def app_seconds(events: DataFrame) -> DataFrame:
    """Time between application start and end; NULL for a log that is still open."""
    start = F.max(F.when(F.col("Event") == "SparkListenerApplicationStart", F.col("Timestamp")))
    end = F.max(F.when(F.col("Event") == "SparkListenerApplicationEnd", F.col("Timestamp")))
    return events.groupBy("log").agg(F.round((end - start) / 1000, 2).alias("spark_app_seconds"))


def stage_metrics(events: DataFrame) -> DataFrame:
    """Per stage: tasks seen, shuffle bytes read, slowest and fastest task, skew ratio.

    The ratio needs two tasks of more than a millisecond.
    """
    counted = F.when(F.col("seconds") > MIN_TASK_SECONDS, F.col("seconds"))
    return (
        tasks(events)
        .groupBy("log", "stage_id")
        .agg(
            F.count(F.lit(1)).alias("task_count"),
            F.sum("shuffle_bytes").alias("shuffle_bytes"),
            F.max(counted).alias("slowest"),
            F.min(counted).alias("fastest"),
            F.count(counted).alias("n"),
        )
        .withColumn("task_skew", F.when(F.col("n") >= 2, F.round(F.col("slowest") / F.col("fastest"), 2)))
        .drop("n")
    )


def heaviest_shuffle_stage(events: DataFrame, min_tasks: int = MIN_TASKS) -> DataFrame:
    """The stage of every run that reads most shuffle bytes, among those with enough
    tasks; ties go to the later stage. Stage names do not tell which stage shuffles."""
    per_run = Window.partitionBy("log").orderBy(F.desc("shuffle_bytes"), F.desc("stage_id"))
    return (
        stage_metrics(events)
        .filter((F.col("task_count") >= min_tasks) & (F.col("shuffle_bytes") > 0))
        .withColumn("_rank", F.row_number().over(per_run))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def run_profile(events: DataFrame) -> DataFrame:
    """One row per run: application seconds, seconds and tasks of its heaviest shuffle
    stage, and that stage's task skew."""
    heavy = heaviest_shuffle_stage(events).select("log", "stage_id", "task_skew")
    timed = heavy.join(stages(events), ["log", "stage_id"], "left")
    return (
        app_seconds(events)
        .join(timed, "log", "left")
        .select(
            "log",
            "spark_app_seconds",
            F.round("stage_seconds", 2).alias("shuffle_stage_seconds"),
            F.col("task_skew").alias("shuffle_task_skew_ratio"),
            F.col("tasks").alias("shuffle_stage_tasks"),
        )
    )


def task_distribution(
    events: DataFrame, quantiles: list[float] = QUANTILES, accuracy: int = 1_000_000
) -> DataFrame:
    """Run time, shuffle bytes, shuffle records and spill of the heaviest shuffle stage's
    tasks at the given quantiles, one row per run, measure and quantile."""
    heavy = heaviest_shuffle_stage(events).select("log", "stage_id")
    measures = ["run_ms", "shuffle_bytes", "shuffle_records", "spill_bytes"]
    sketched = (
        tasks(events)
        .join(heavy, ["log", "stage_id"], "left_semi")
        .groupBy("log")
        .agg(*[F.percentile_approx(m, quantiles, accuracy).alias(m) for m in measures])
    )
    points = F.arrays_zip(F.array(*[F.lit(q) for q in quantiles]).alias("quantile"), F.col("value"))
    return (
        sketched.unpivot("log", measures, "measure", "value")
        .select("log", "measure", F.explode(points).alias("p"))
        .select("log", "measure", F.col("p.quantile").alias("quantile"), F.col("p.value").alias("value"))
    )
