"""Pricing: join each transaction to the rate version valid on its day.

One question, several physical plans, one answer. The equi-key is (mcc, country, entry
mode); the range predicate picks the version whose closed validity interval holds the
transaction day. Validity intervals of a key do not overlap (see
``windows.overlapping_versions``), so a row has at most one match and rows without one
are out of scope.

Strategy    | plan
------------+-------------------------------------------------------------------------
auto        | period key, broadcast when the measured card fits, else salted hot keys
naive       | sort-merge join with the full rate card
pruned      | sort-merge join with versions cut to the fact window
broadcast   | pruned card broadcast when its measured size allows, else as salted
salted      | fact salted by transaction id, pruned card copied per bucket
isolate     | hot keys joined to their broadcast slice, the rest sort-merged, union
period_key  | range turned into an equality on the schedule period, sort-merge join
aqe         | pruned card, no hints: adaptive execution splits skewed partitions
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.dates import overlaps, period_index
from sparkretail.functions.money import interchange_fee
from sparkretail.operators.clean import split_on
from sparkretail.operators.skew import (
    BROADCAST_BYTES,
    BUCKETS,
    fits_broadcast,
    hot_keys,
    replicate,
    salt_of,
    salted_join,
)

KEYS = ["mcc", "country_code", "entry_mode"]
MOST_ISOLATED = 100
STRATEGIES = ("naive", "pruned", "broadcast", "salted", "isolate", "period_key", "aqe", "auto")

# Fixed values of the published schedule: weekly versions from this day on.
SCHEDULE_EPOCH = dt.date(2024, 1, 1)
SCHEDULE_STEP_DAYS = 7
APPROVED = "00"

FACT_COLUMNS = ["txn_id", "txn_ts", *KEYS, "amount"]
RATE_COLUMNS = ["rate_id", *KEYS, "effective_from", "effective_to", "rate_bps", "fixed_fee"]

_SALT, _PERIOD = "_salt", "_period"


def approved(fact: DataFrame) -> DataFrame:
    """Approved transactions, cut to the columns pricing or its rollups look at."""
    return fact.filter(F.col("response_code") == APPROVED).select(*FACT_COLUMNS)


def in_window(rates: DataFrame, window: tuple[dt.date, dt.date] | None) -> DataFrame:
    """Rate versions that can match a fact inside ``window`` (both ends included). Spark
    cannot derive this from the join: it needs to know the dates of the fact."""
    slim = rates.select(*RATE_COLUMNS)
    if window is None:
        return slim
    return slim.filter(overlaps(F.col("effective_from"), F.col("effective_to"), *window))


def fact_window(fact: DataFrame) -> tuple[dt.date, dt.date] | None:
    """First and last transaction day, for callers who do not know them."""
    low, high = fact.agg(F.min(F.to_date("txn_ts")), F.max(F.to_date("txn_ts"))).first()
    return None if low is None else (low, high)


def _valid(df: DataFrame) -> DataFrame:
    """Range predicate. On top of an inner join it becomes part of the join condition."""
    return df.filter(F.to_date("txn_ts").between(F.col("effective_from"), F.col("effective_to")))


def _with_period(
    fact: DataFrame,
    rates: DataFrame,
    window: tuple[dt.date, dt.date],
    epoch: dt.date,
    step_days: int,
) -> tuple[DataFrame, DataFrame]:
    """Give both sides the schedule period. A version gets one row per period it touches
    inside the window, which is one row on the published schedule and stays right for
    versions that are longer than a period or not aligned with it."""
    low, high = window
    first = period_index(F.greatest(F.col("effective_from"), F.lit(low)), epoch, step_days)
    last = period_index(F.least(F.col("effective_to"), F.lit(high)), epoch, step_days)
    return (
        fact.withColumn(_PERIOD, period_index(F.to_date("txn_ts"), epoch, step_days)),
        rates.withColumn(_PERIOD, F.explode(F.sequence(first, last))),
    )


def _salted(fact: DataFrame, rates: DataFrame, buckets: int) -> DataFrame:
    joined = fact.withColumn(_SALT, salt_of("txn_id", buckets)).join(
        replicate(rates, buckets, _SALT).hint("merge"), [*KEYS, _SALT]
    )
    return _valid(joined).drop(_SALT)


def is_key(values: Sequence[str]) -> Column:
    """The row has this (category, country, entry mode)."""
    return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(KEYS, values)])


def _isolated(
    fact: DataFrame, rates: DataFrame, hot: Sequence[Sequence[str]] | None, max_bytes: int
) -> DataFrame:
    further = True
    if hot is None:
        # The heaviest keys; any further one is cut by the salted join of the cold side.
        found = hot_keys(fact.dropna(subset=KEYS), KEYS).orderBy(F.desc("parts"), *KEYS)
        hot = [tuple(row) for row in found.select(*KEYS).limit(MOST_ISOLATED + 1).collect()]
        further = len(hot) > MOST_ISOLATED
        hot = hot[:MOST_ISOLATED]
    if not hot:
        return _valid(fact.join(rates.hint("merge"), KEYS))
    is_hot = reduce(lambda a, b: a | b, [is_key(v) for v in hot])
    hot_fact, cold_fact = split_on(fact, is_hot)
    hot_rates, cold_rates = split_on(rates, is_hot)
    if fits_broadcast(hot_rates, max_bytes):
        hot_part = _valid(hot_fact.join(F.broadcast(hot_rates), KEYS))
    else:
        hot_part = _salted(hot_fact, hot_rates, BUCKETS)
    if further:
        cold_part = _valid(salted_join(cold_fact, cold_rates, KEYS, hint="merge"))
    else:
        cold_part = _valid(cold_fact.join(cold_rates.hint("merge"), KEYS))
    return hot_part.unionByName(cold_part)


def price(
    fact: DataFrame,
    rates: DataFrame,
    strategy: str = "auto",
    window: tuple[dt.date, dt.date] | None = None,
    buckets: int = BUCKETS,
    hot: Sequence[Sequence[str]] | None = None,
    epoch: dt.date = SCHEDULE_EPOCH,
    step_days: int = SCHEDULE_STEP_DAYS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact rows with the columns of their rate version.

    ``window`` is the first and last day in the fact (a superset is fine). Without it the
    card is not pruned, and the period strategies look the days up with one aggregate.
    ``hot`` names the keys to isolate; without it they are found by counting.
    """
    if strategy == "naive":
        return _valid(fact.join(rates.select(*RATE_COLUMNS).hint("merge"), KEYS))
    pruned = in_window(rates, window)
    if strategy == "pruned":
        return _valid(fact.join(pruned.hint("merge"), KEYS))
    if strategy == "aqe":
        return _valid(fact.join(pruned, KEYS))
    if strategy == "salted":
        return _salted(fact, pruned, buckets)
    if strategy == "broadcast":
        if fits_broadcast(pruned, max_bytes):
            return _valid(fact.join(F.broadcast(pruned), KEYS))
        return _salted(fact, pruned, buckets)
    if strategy == "isolate":
        return _isolated(fact, pruned, hot, max_bytes)
    if strategy not in ("period_key", "auto"):
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")

    window = window or fact_window(fact)
    if window is None:
        return _valid(fact.join(pruned, KEYS))
    keyed_fact, keyed_rates = _with_period(fact, in_window(rates, window), window, epoch, step_days)
    keys = [*KEYS, _PERIOD]
    if strategy == "period_key":
        joined = keyed_fact.join(keyed_rates.hint("merge"), keys)
    elif fits_broadcast(keyed_rates, max_bytes):
        joined = keyed_fact.join(F.broadcast(keyed_rates), keys)
    else:
        joined = salted_join(keyed_fact, keyed_rates, keys)
    return _valid(joined).drop(_PERIOD)


def priced_rows(priced: DataFrame) -> DataFrame:
    """Row-level output: the transaction, its rate version and its fee."""
    return priced.select(
        "txn_id", "txn_ts", *KEYS, "amount", "rate_id",
        interchange_fee("amount", "rate_bps", "fixed_fee").alias("interchange_fee"),
    )
