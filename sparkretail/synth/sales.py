"""Retail sales rows and planted defects.

Every generator takes a DataFrame with a non-negative ``key`` column, from
``spark.range`` or from an existing table, and derives each column from the key with
``functions.draws``. Output does not depend on partitioning and no row is drawn twice
under a retry.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.draws import constant_map, fenced, pick, with_draws
from sparkretail.synth.reference_data import (
    NOT_COMPLETED,
    SALES_CHANNELS,
    SALES_COUNTRIES,
    SALES_CURRENCIES,
    SALES_PAYMENTS,
)

BUSINESS_DAY = dt.datetime(2026, 1, 15)

# The defects a cleaning run must handle.
DIRT_KINDS = (
    "null_product_id",
    "qty_zero",
    "qty_100",
    "null_discount",
    "currency_usd_alias",
    "status_complete_alias",
    "qty_negative",
    "qty_over",
    "currency_dollar",
    "currency_null",
    "currency_inr",
    "status_Complete",
    "status_cancelled",
    "status_pending",
)

# The edges a ticket-collapse run must handle.
TICKET_EDGES = (
    "exact_dup",
    "padded_txn",
    "not_pos",
    "padded_original",
    "triple_dup",
    "not_pos_dup",
)


def key_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "key")


def uuid_text(key: Column) -> Column:
    """Hex digest of the key in the five-part layout of a UUID."""
    digest = F.md5(key.cast("string").cast("binary"))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, n) for start, n in parts])


def _amount(cents: Column, type_: str) -> Column:
    return (cents / F.lit(100.0)).cast(type_)


def sales(keys: DataFrame, seed: int = 42) -> DataFrame:
    """Clean sales of one business day, 09:00 to 21:00 UTC, fifteen columns."""
    streams = ("store", "register", "product", "customer", "qty", "price", "disc", "cur",
               "chan", "pay", "ctry", "sec")
    drawn = with_draws(keys, "key", {f"u_{s}": seed * 100 + i for i, s in enumerate(streams)})
    u = {s: F.col(f"u_{s}") for s in streams}
    product = (u["product"] % 1000 + 1).cast("int")
    opening = F.lit(BUSINESS_DAY.replace(hour=9))
    return drawn.select(
        uuid_text(F.concat_ws(":", F.lit(seed), F.col("key"))).alias("txn_id"),
        (u["store"] % 50 + 1).cast("int").alias("store_id"),
        (u["register"] % 8 + 1).cast("int").alias("register_id"),
        product.alias("product_id"),
        F.concat(F.lit("SKU-"), F.lpad(product.cast("string"), 5, "0")).alias("product_code"),
        (u["customer"] % 50_000 + 1).cast("int").alias("customer_id"),
        (u["qty"] % 99 + 1).cast("int").alias("quantity"),
        _amount(u["price"] % 9_900 + 100, "decimal(10,2)").alias("unit_price"),
        _amount(u["disc"] % 51, "decimal(5,2)").alias("discount_pct"),
        pick(u["cur"], SALES_CURRENCIES).alias("currency"),
        F.lit("COMPLETED").alias("status"),
        pick(u["chan"], SALES_CHANNELS).alias("channel"),
        pick(u["pay"], SALES_PAYMENTS).alias("payment_method"),
        pick(u["ctry"], SALES_COUNTRIES).alias("country_code"),
        F.timestamp_add("SECOND", (u["sec"] % (12 * 3600)).cast("int"), opening).alias("event_ts"),
    )


def dirt_kind(
    key: Column | str, rate: float, kinds: Sequence[str], seed: int
) -> tuple[dict[str, int], Column]:
    """Draw columns and the expression that names a row's defect (NULL for a clean row)."""
    streams = {"u_dirt": seed * 100 + 50, "u_kind": seed * 100 + 51, "u_value": seed * 100 + 52}
    name = F.when(F.col("u_dirt") % 10_000 < int(rate * 10_000), pick(F.col("u_kind"), kinds))
    return streams, name


def plant_dirt(
    rows: DataFrame,
    key: str,
    rate: float = 0.12,
    kinds: Sequence[str] = DIRT_KINDS,
    seed: int = 42,
    keep_kind: bool = False,
) -> DataFrame:
    """Spoil a share of the rows, one defect each. ``keep_kind`` adds the defect's name."""
    streams, name = dirt_kind(key, rate, kinds, seed)
    drawn = with_draws(rows, key, streams).withColumn("kind", name)
    kind, value = F.col("kind"), F.col("u_value")

    def on(column: str, changes: dict[str, object]) -> Column:
        """The value a kind maps to, else the old one. One lookup instead of a chain of
        comparisons: the defect's name is itself a long expression."""
        type_ = rows.schema[column].dataType
        old = F.col(column)
        fixed = {k: v for k, v in changes.items() if v is not None}
        if fixed:
            old = F.coalesce(F.element_at(constant_map(fixed), kind).cast(type_), old)
        for k in changes.keys() - fixed.keys():
            old = F.when(kind.eqNullSafe(k), F.lit(None).cast(type_)).otherwise(old)
        return old

    drawn_quantity = F.when(
        kind == "qty_over", (value % 400 + 101).cast("int")
    ).when(kind == "qty_negative", (value % 2 * 4 - 5).cast("int"))
    changed = {
        "product_id": on("product_id", {"null_product_id": None}),
        "quantity": F.coalesce(drawn_quantity, on("quantity", {"qty_zero": 0, "qty_100": 100})),
        "discount_pct": on("discount_pct", {"null_discount": None}),
        "currency": on(
            "currency",
            {
                "currency_usd_alias": "usd",
                "currency_dollar": "$",
                "currency_inr": "INR",
                "currency_null": None,
            },
        ),
        "status": on(
            "status",
            {
                "status_complete_alias": "complete",
                "status_Complete": "Complete",
                "status_cancelled": "CANCELLED",
                "status_pending": "PENDING",
            },
        ),
    }
    spoiled = fenced(drawn, changed).select(*rows.columns, "kind")
    return spoiled if keep_kind else spoiled.drop("kind")


def plant_ticket_edges(
    rows: DataFrame,
    key: str,
    rate: float = 0.12,
    kinds: Sequence[str] = TICKET_EDGES,
    seed: int = 42,
) -> DataFrame:
    """Duplicate, pad and re-channel a share of the tickets.

    Each row turns into the list of its variants, which is unrolled in place: the copies
    need no second scan and no union.
    """
    streams, name = dirt_kind(key, rate, kinds, seed + 1)
    drawn = with_draws(rows, key, streams).withColumn("_kind", name)
    kind = F.coalesce(F.col("_kind"), F.lit(""))
    plain, padded = F.col("txn_id"), F.concat(F.lit("  "), F.col("txn_id"), F.lit("  "))
    ids = (
        F.when(kind.isin("exact_dup", "not_pos_dup"), F.array(plain, plain))
        .when(kind == "triple_dup", F.array(plain, plain, plain))
        .when(kind == "padded_txn", F.array(plain, padded))
        .when(kind == "padded_original", F.array(F.concat(F.lit(" "), plain, F.lit(" "))))
        .otherwise(F.array(plain))
    )
    channel = F.when(
        kind.isin("not_pos", "not_pos_dup"), pick(F.col("u_value"), ("web", "app"))
    ).otherwise(F.col("channel"))
    return (
        drawn.withColumn("channel", channel)
        .withColumn("txn_id", F.explode(ids))
        .select(*rows.columns)
    )


def audit_envelopes(template: DataFrame, product_ids: Sequence[int]) -> DataFrame:
    """Non-sales rows that carry the sample seed: one per product id, from one template
    row. The number of envelopes is a handful."""
    envelopes = F.explode(
        F.array(
            *[
                F.struct(F.lit(f"AUDIT-{chr(65 + i)}").alias("t"), F.lit(p).cast("int").alias("p"))
                for i, p in enumerate(product_ids)
            ]
        )
    )
    return (
        template.limit(1)
        .withColumn("_e", envelopes)
        .withColumns(
            {
                "txn_id": F.col("_e.t"),
                "product_id": F.col("_e.p"),
                "product_code": F.concat(F.lit("SKU-"), F.lpad(F.col("_e.p").cast("string"), 5, "0")),
                "channel": F.lit("AUDIT"),
                "status": F.lit("COMPLETED"),
                "quantity": F.lit(1),
            }
        )
        .select(*template.columns)
    )


def store_floor_and_decoys(
    rows: DataFrame,
    key: str,
    floor_stores: tuple[int, int],
    decoy_stores: tuple[int, int],
    floor_share: float = 0.82,
    seed: int = 42,
) -> DataFrame:
    """Spread rows over qualifying stores and lower-numbered decoys that never qualify:
    a decoy ticket is not in-store or not completed. Ranges include both ends."""
    base = seed * 100 + 60
    drawn = with_draws(rows, key, {"u_side": base, "u_store": base + 1, "u_how": base + 2, "u_which": base + 3})
    is_floor = F.col("u_side") % 100 < int(floor_share * 100)
    wrong_channel = F.col("u_how") % 100 < 55

    def store(bounds: tuple[int, int]) -> Column:
        return (F.col("u_store") % (bounds[1] - bounds[0] + 1) + bounds[0]).cast("int")

    return (
        drawn.withColumns(
            {
                "store_id": F.when(is_floor, store(floor_stores)).otherwise(store(decoy_stores)),
                "channel": F.when(is_floor | ~wrong_channel, "POS").otherwise(
                    pick(F.col("u_which"), ("web", "app"))
                ),
                "status": F.when(is_floor | wrong_channel, "COMPLETED").otherwise(
                    pick(F.col("u_which"), NOT_COMPLETED)
                ),
            }
        ).select(*rows.columns)
    )
