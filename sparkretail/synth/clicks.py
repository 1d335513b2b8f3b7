"""Versioned catalog, click events, attribution streams and wide events."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.draws import draw, pick, with_draws
from sparkretail.synth import reference_data as ref
from sparkretail.synth.payments import padded

CATALOG_FIRST_DAY = dt.date(2020, 1, 1)
STREAM_START = dt.datetime(2024, 6, 1, 12, 0, 0)
WIDE_START = dt.datetime(2024, 6, 1)
VERSION_STEP_DAYS = 7


def catalog(
    products: DataFrame,
    n_versions: int,
    tie_rate: float = 0.0,
    payload_chars: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Append-only version history of every ``product_id`` in ``products``, whose integer
    type it keeps.

    Versions are a week apart; ``tie_rate`` of the products get a second row on the last
    day. Versions and ties are unrolled from one list per product.
    """
    streams = {"u_tie": seed * 100 + 70}
    pid = F.col("product_id")
    last = n_versions - 1
    has_tie = F.col("u_tie") % 10_000 < int(tie_rate * 10_000)
    versions = F.sequence(F.lit(0), F.lit(last))
    # Version number -1 marks the tie.
    listed = F.when(has_tie, F.concat(versions, F.array(F.lit(-1)))).otherwise(versions)
    rows = (
        with_draws(products.select("product_id"), "product_id", streams)
        .withColumn("v", F.explode(listed))
        .withColumn("is_tie", F.col("v") < 0)
        .withColumn("n", F.when(F.col("is_tie"), last).otherwise(F.col("v")))
        .withColumn("u_category", draw(pid * n_versions + F.col("n"), seed * 100 + 71))
    )
    tie, n = F.col("is_tie"), F.col("n")
    current = pick(pid, ref.CATEGORIES)
    return rows.select(
        pid,
        F.concat(
            F.lit("sku-"), padded(pid, 8),
            F.when(tie, "-alt").otherwise(F.concat(F.lit("-v"), padded(n, 3))),
        ).alias("product_name"),
        F.when(tie, "Kitchen")
        .when(n == last, current)
        .otherwise(pick(F.col("u_category"), ref.CATEGORIES))
        .alias("category"),
        pick(pid, ref.BRANDS).alias("brand"),
        ((pid % 4000 + 1000 + n * 25) / F.lit(100.0)).cast("decimal(10,2)").alias("list_price"),
        F.date_add(F.lit(CATALOG_FIRST_DAY), (n * VERSION_STEP_DAYS).cast("int")).alias("effective_ts"),
        F.repeat(F.when(tie, "y").otherwise("x"), payload_chars).cast("binary").alias("payload"),
    )


def click_events(
    keys: DataFrame, n_products: int, orphan_rate: float = 0.03, seed: int = 42
) -> DataFrame:
    """Click events on products 1..n, a share of them on unknown products."""
    names = ("pid", "orphan", "type", "cents", "qty", "visitor", "chan", "ctry")
    drawn = with_draws(keys, "key", {f"u_{s}": seed * 100 + 80 + i for i, s in enumerate(names)})
    u = {s: F.col(f"u_{s}") for s in names}
    kind = pick(u["type"], ref.CLICK_TYPES)
    unknown = u["orphan"] % 10_000 < int(orphan_rate * 10_000)
    return drawn.select(
        F.col("key").alias("event_id"),
        F.when(unknown, u["pid"] % 199 + 1 + n_products)
        .otherwise(u["pid"] % n_products + 1)
        .cast("int")
        .alias("product_id"),
        kind.alias("event_type"),
        ((u["cents"] % 9_900 + 100) / F.lit(100.0)).cast("decimal(10,2)").alias("amount"),
        F.when(kind.isin("purchase", "refund"), u["qty"] % 5 + 1).otherwise(0).cast("int").alias("quantity"),
        F.concat(F.lit("sess-"), padded(F.col("key"), 12)).alias("session_id"),
        F.concat(F.lit("vis-"), padded(u["visitor"] % 50_000 + 1, 6)).alias("visitor_id"),
        pick(u["chan"], ref.CLICK_CHANNELS).alias("channel"),
        pick(u["ctry"], ref.CLICK_COUNTRIES).alias("country_code"),
    )


@dataclass(frozen=True)
class StreamSpec:
    """Shape of one attribution drop: rows per event-time minute (one file each)."""

    files: int
    visitors: int
    impressions: int
    ontime: int
    orphan: int
    wide: int = 0
    wide_lookback: int = 11
    late: int = 0
    late_from: int = 99

    @property
    def purchases(self) -> int:
        return self.ontime + self.orphan + self.wide + self.late


# The two published drops.
CLEAN_DROP = StreamSpec(files=6, visitors=400, impressions=400, ontime=50, orphan=8, wide_lookback=15)
LATE_DROP = StreamSpec(
    files=12, visitors=6_000, impressions=6_000, ontime=800, orphan=80, wide=80, late=200, late_from=8
)

CAMPAIGNS = 40
LOOKBACK_MINUTES = 6


def _seconds_after(start: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), start)


def _impression_visitor(imp: Column, spec: StreamSpec, seed: int) -> Column:
    return draw(imp, seed * 100 + 1) % spec.visitors


def _impression_second(imp: Column, spec: StreamSpec, seed: int) -> Column:
    """Event time of an impression in seconds after the start of the drop."""
    return F.floor(imp / spec.impressions) * 60 + draw(imp, seed * 100 + 2) % 46


def _visitor_text(index: Column) -> Column:
    return F.concat(F.lit("vis-"), padded(index, 6))


def impressions(spark: SparkSession, spec: StreamSpec, seed: int = 42) -> DataFrame:
    """Impressions with the ``minute`` (file) they arrive in."""
    imp = F.col("id")
    start = F.lit(STREAM_START)
    return spark.range(spec.files * spec.impressions).select(
        F.floor(imp / spec.impressions).cast("int").alias("minute"),
        F.concat(F.lit("imp-"), padded(imp, 8)).alias("impression_id"),
        _visitor_text(_impression_visitor(imp, spec, seed)).alias("visitor_id"),
        F.concat(F.lit("camp-"), padded(draw(imp, seed * 100 + 3) % CAMPAIGNS, 3)).alias("campaign_id"),
        _seconds_after(start, _impression_second(imp, spec, seed)).alias("impression_ts"),
        pick(draw(imp, seed * 100 + 4), ref.CLICK_CHANNELS).alias("channel"),
    )


def purchases(spark: SparkSession, spec: StreamSpec, seed: int = 42) -> DataFrame:
    """Purchases of four kinds with the ``minute`` (file) they arrive in.

    A purchase refers to an impression by number and recomputes that impression's visitor
    and time, so nothing is joined. On time: within its own minute, after an impression
    of the last six. Orphan: a visitor without impressions. Wide: on time, but outside
    the join window. Late: inside the window of an impression of the first three
    minutes, arriving after the watermark has passed.
    """
    n = F.col("id")
    minute = F.floor(n / spec.purchases)
    slot = n % spec.purchases
    u = [draw(n, seed * 100 + 10 + i) for i in range(5)]
    kinds = [("ontime", spec.ontime), ("orphan", spec.orphan), ("wide", spec.wide), ("late", spec.late)]
    kind, upper = F.lit("late"), spec.purchases
    for name, count in reversed(kinds):
        kind = F.when(slot < upper, name).otherwise(kind)
        upper -= count
    rows = (
        spark.range(spec.files * spec.purchases)
        .select("id", minute.alias("minute"), kind.alias("kind"), *[c.alias(f"u{i}") for i, c in enumerate(u)])
        .filter((F.col("kind") != "wide") | (F.col("minute") >= spec.wide_lookback))
        .filter((F.col("kind") != "late") | (F.col("minute") >= spec.late_from))
    )
    kind, minute = F.col("kind"), F.col("minute")
    oldest = F.greatest(minute - LOOKBACK_MINUTES, F.lit(0))
    source_minute = (
        F.when(kind == "ontime", oldest + F.col("u0") % (minute - oldest + 1))
        .when(kind == "wide", minute - spec.wide_lookback)
        .otherwise(draw(minute, seed * 100 + 20) % 3)
    )
    rows = rows.withColumn("source", source_minute * spec.impressions + F.col("u1") % spec.impressions)
    rows = rows.withColumn("source_s", _impression_second(F.col("source"), spec, seed))
    earliest = F.greatest(F.col("source_s") + 1, minute * 60)
    latest = minute * 60 + 50
    second = (
        F.when(kind == "ontime", earliest + F.col("u2") % F.greatest(latest - earliest + 1, F.lit(1)))
        .when(kind == "late", F.col("source_s") + 30 + F.col("u2") % 211)
        .otherwise(minute * 60 + F.col("u2") % 46)
    )
    visitor = F.when(
        kind == "orphan", F.concat(F.lit("vis-orphan-"), padded(F.col("u1") % 10_000, 4))
    ).otherwise(_visitor_text(_impression_visitor(F.col("source"), spec, seed)))
    return rows.filter((kind != "ontime") | (earliest <= latest)).select(
        minute.cast("int").alias("minute"),
        F.concat_ws("-", F.lit("pur"), padded(minute, 2), kind, padded(F.col("id"), 6)).alias("purchase_id"),
        visitor.alias("visitor_id"),
        (F.col("u3") % 4_000 + 1_000).cast("int").alias("product_id"),
        ((F.col("u4") % 19_501 + 499) / F.lit(100.0)).cast("decimal(10,2)").alias("amount"),
        _seconds_after(F.lit(STREAM_START), second).alias("purchase_ts"),
    )


def wide_events(keys: DataFrame, payload_chars: int = 256, seed: int = 42) -> DataFrame:
    """Events with a high-entropy payload, for exports under memory pressure."""
    base = seed * 100 + 90
    drawn = with_draws(keys, "key", {"u_s": base, "u_us": base + 1, "u_cents": base + 2, "u_region": base + 3})
    blocks = -(-payload_chars // 128)
    payload = F.concat(
        *[
            F.sha2(F.concat_ws(":", F.lit(seed), F.lit(i), F.col("key")).cast("binary"), 512)
            for i in range(blocks)
        ]
    )
    micros = F.col("u_s") % (30 * 86_400) * 1_000_000 + F.col("u_us") % 1_000_000
    return drawn.select(
        F.col("key").alias("event_id"),
        F.timestamp_micros(micros + F.unix_micros(F.lit(WIDE_START))).cast("timestamp_ntz").alias("event_ts"),
        ((F.col("u_cents") % 4_999_999 + 1) / F.lit(100.0)).cast("decimal(12,2)").alias("amount"),
        pick(F.col("u_region"), ref.REGIONS).alias("region"),
        F.substring(payload, 1, payload_chars).alias("payload"),
    )
