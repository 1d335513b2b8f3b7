"""Key-existence joins, joins to the current version, and event-time interval pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.dates import epoch_micros, time_bucket
from sparkretail.operators.skew import BROADCAST_BYTES, ROWS_PER_TASK, salted_join, sized_join
from sparkretail.operators.windows import current_catalog


def orphans(
    left: DataFrame, right: DataFrame, keys: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left rows without a partner; a NULL key has none. Only the keys of the right side
    travel, once each."""
    return sized_join(left, right.select(*keys).distinct(), list(keys), "left_anti", max_bytes)


def matched(
    left: DataFrame, right: DataFrame, keys: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left rows with a partner, each once."""
    return sized_join(left, right.select(*keys).distinct(), list(keys), "left_semi", max_bytes)


def enrich_current(
    events: DataFrame, catalog: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Events with the current version of their product; events of unknown products drop."""
    return sized_join(events, current_catalog(catalog), ["product_id"], "inner", max_bytes).select(
        "event_id", "product_id", "event_type", "amount",
        "product_name", "category", "brand", "list_price", "effective_ts",
    )


def interval_pairs(
    first: DataFrame,
    second: DataFrame,
    key: str,
    first_ts: str,
    second_ts: str,
    within_seconds: int,
    output: Sequence[Column] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Every pair with equal key and ``first_ts <= second_ts <= first_ts + within``.

    Time is cut into slots as wide as the window. A partner lies in the same slot or the
    next one, so the join runs on (key, slot) with each first row in two slots. One busy
    visitor is spread over all slots of the period and never meets its whole history:
    the rows compared stay proportional to the pairs returned. A (key, slot) that still
    holds more than ``rows_per_task`` rows of the first side, a burst of one robot, is
    salted; None leaves out the count that finds such slots. All pairs inside the window
    are the result, so a robot's rows within one window are returned pairwise.

    The inputs must not share column names other than ``key``; it appears once.
    """
    slot = "_slot"
    first_slots = first.withColumn(
        slot,
        F.explode(
            F.array(
                time_bucket(F.col(first_ts), within_seconds),
                time_bucket(F.col(first_ts), within_seconds) + 1,
            )
        ),
    )
    second_slots = second.withColumn(slot, time_bucket(F.col(second_ts), within_seconds))
    gap = epoch_micros(F.col(second_ts)) - epoch_micros(F.col(first_ts))
    if rows_per_task is None:
        joined = first_slots.join(second_slots, [key, slot])
    else:
        joined = salted_join(first_slots, second_slots, [key, slot], rows_per_task=rows_per_task)
    pairs = joined.filter(gap.between(0, within_seconds * 1_000_000))
    return pairs.select(*output) if output else pairs.drop(slot)
