"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BASE_CONF = {
    # Month, hour and date-range results must not depend on where the job runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call-site capture costs two JVM calls per column expression while a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

PROFILES = {
    "default": {},
    # Split thresholds low enough to trip on executors with little memory. Coalescing
    # is off because it would merge the pieces of a split partition again.
    "skew_aqe": {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    },
    "no_broadcast": {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    },
    # Join state lives off-heap and on local disk instead of in the executor heap.
    "streaming": {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    },
}


def get_session(
    app: str = "sparkretail",
    profile: str = "default",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the base settings, a named profile and overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **PROFILES[profile], **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def conf_overlay(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set runtime options for an action that runs inside the block, then put them back.

    Only for eager work: a DataFrame that is returned from the block is planned later,
    with whatever the session says then.
    """
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def profiled(spark: SparkSession, profile: str) -> SparkSession:
    """A further session of the same application with a profile of its own.

    Unlike ``conf_overlay`` it leaves the caller's settings alone, and what it returns
    later is still planned under the profile.
    """
    own = spark.newSession()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in {**BASE_CONF, **PROFILES[profile], "spark.sql.shuffle.partitions": partitions}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder, so tests run. A
    cluster session without it is an error: a machine-local folder would be invisible
    to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="sparkretail-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/sparkretail/{label}-{uuid.uuid4().hex}"
