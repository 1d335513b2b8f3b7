"""The library's table families, derived from the given tables.

Each function has a SQL text next to it that states the same derivation. Prices, dates,
keys and quantities come from the tables; codes the tables lack (channel, payment
method, merchant category, ...) are drawn from the row key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.draws import (
    MODULUS,
    pick,
    pick_weighted,
    stream_factor,
    with_draws,
)
from sparkretail.synth import payments as pay
from sparkretail.synth import reference_data as ref

# Wide enough for totals of quantity x extended price at any table size.
MONEY_DIGITS = 24

CHANNEL_WEIGHTS = [("POS", 60), ("ONLINE", 15), ("web", 15), ("app", 10)]
STATUS_WEIGHTS = [("COMPLETED", 90), ("CANCELLED", 5), ("PENDING", 5)]
SALES_STREAMS = {
    "u_customer": 11, "u_currency": 12, "u_status": 13, "u_channel": 14, "u_payment": 15,
    "u_country": 16, "u_second": 17,
}
HOT_SHARE = 0.75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- SQL building blocks --------------------------------------------------------------


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def sql_pick(u: str, values) -> str:
    return f"{sql_list(values)}[1 + {u} % {len(values)}]"


def sql_pick_weighted(u: str, weighted) -> str:
    total, upper, cases = sum(w for _, w in weighted), 0, ""
    for value, weight in weighted[:-1]:
        upper += weight
        cases += f" WHEN {u} % {total} < {upper} THEN '{value}'"
    return f"CASE{cases} ELSE '{weighted[-1][0]}' END"


def sql_padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, greatest({width}, length({text}))::INT, '0')"


def sql_draws(source: str, target: str, key: str, streams: dict[str, int]) -> str:
    """CTE ``target``: ``source`` plus one draw column per stream."""
    draws = ", ".join(
        f"(({key}) % {MODULUS - 1} + 1) * {stream_factor(s)} % {MODULUS} AS {name}"
        for name, s in streams.items()
    )
    return f"{target} AS (SELECT *, {draws} FROM {source})"


# ---- Row keys -------------------------------------------------------------------------


def line_key() -> Column:
    """Number of a line; (order, line number) alone repeats in the given tables."""
    order = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return order * 7919 + F.col("l_partkey") % 7919


LINE_KEY_SQL = "((l_orderkey * 8 + l_linenumber) * 7919 + l_partkey % 7919)"
LINES_SQL = f"lines AS (SELECT *, {LINE_KEY_SQL} AS key FROM lineitem)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("key", line_key())


# ---- Retail sales ---------------------------------------------------------------------


def _payment(store: Column, u: Column) -> Column:
    """30 % of the stores take cards only, 40 % cards and cash, 30 % all three."""
    return (
        F.when(store % 10 < 3, "card")
        .when(store % 10 < 7, pick(u, ref.SALES_PAYMENTS[:2]))
        .otherwise(pick(u, ref.SALES_PAYMENTS))
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per line item: supplier as store, part as product, a time of day drawn
    onto the ship date."""
    u = {name: F.col(name) for name in SALES_STREAMS}
    return with_draws(lines(spark, sf_dir), "key", SALES_STREAMS).select(
        "key",
        F.concat(F.lit("T"), F.col("key").cast("string")).alias("txn_id"),
        F.col("l_suppkey").cast("int").alias("store_id"),
        F.col("l_linenumber").alias("register_id"),
        F.col("l_partkey").alias("product_id"),
        (u["u_customer"] % 50_000 + 1).cast("int").alias("customer_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount_pct"),
        pick(u["u_currency"], ref.SALES_CURRENCIES).alias("currency"),
        pick_weighted(u["u_status"], STATUS_WEIGHTS).alias("status"),
        pick_weighted(u["u_channel"], CHANNEL_WEIGHTS).alias("channel"),
        _payment(F.col("l_suppkey"), u["u_payment"]).alias("payment_method"),
        pick(u["u_country"], ref.SALES_COUNTRIES).alias("country_code"),
        F.timestamp_add("SECOND", (u["u_second"] % 86_400).cast("int"), F.col("l_shipdate")).alias(
            "event_ts"
        ),
    )


SALES_SQL = f"""{LINES_SQL},
{sql_draws("lines", "sales_draws", "key", SALES_STREAMS)},
sales AS (SELECT key, 'T' || CAST(key AS VARCHAR) AS txn_id,
  CAST(l_suppkey AS INT) AS store_id, CAST(l_partkey AS INT) AS product_id,
  u_customer % 50000 + 1 AS customer_id, CAST(l_quantity AS INT) AS quantity,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
  CAST(l_discount AS DECIMAL(5,2)) AS discount_pct,
  {sql_pick("u_currency", ref.SALES_CURRENCIES)} AS currency,
  {sql_pick_weighted("u_status", STATUS_WEIGHTS)} AS status,
  {sql_pick_weighted("u_channel", CHANNEL_WEIGHTS)} AS channel,
  CASE WHEN l_suppkey % 10 < 3 THEN 'card'
       WHEN l_suppkey % 10 < 7 THEN {sql_pick("u_payment", ref.SALES_PAYMENTS[:2])}
       ELSE {sql_pick("u_payment", ref.SALES_PAYMENTS)} END AS payment_method,
  {sql_pick("u_country", ref.SALES_COUNTRIES)} AS country_code,
  l_shipdate + to_seconds(u_second % 86400) AS event_ts
  FROM sales_draws)"""

# Line formulas in SQL decimals, rounded per line.
REVENUE_SQL = (
    "round(CAST(CAST(quantity AS DECIMAL(8,0)) * unit_price * (1.00 - discount_pct)"
    " AS DECIMAL(28,4)), 2)"
)
CONTRIBUTION_SQL = (
    "round(CAST(CAST(quantity AS DECIMAL(6,0)) * unit_price"
    " * CAST((1.00 - discount_pct) * (1.00 - discount_pct) AS DECIMAL(8,4)) AS DECIMAL(30,6)), 2)"
)


# ---- Card payments --------------------------------------------------------------------


PRICING_COLUMNS = ("txn_id", "txn_ts", "mcc", "country_code", "entry_mode", "response_code")


def payments(
    spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = PRICING_COLUMNS
) -> DataFrame:
    """One payment per line item over its extended price; 75 % share one pricing key."""
    made = pay.payments(
        payment_keys(spark, sf_dir),
        hot_share=HOT_SHARE,
        keep=("l_extendedprice",),
        columns=columns,
    )
    return made.withColumnRenamed("l_extendedprice", "amount")


def payment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("key", "l_extendedprice")


_P = pay.STREAMS
_HOT_LIMIT = int(pay.hot_key_probability(HOT_SHARE) * pay.MILLION)
_FORCED = f"u_hot % {pay.MILLION} < {_HOT_LIMIT}"

PAYMENTS_SQL = f"""{LINES_SQL},
{sql_draws("lines", "pay_draws", "key", _P)},
payments AS (SELECT *, 'TXN' || {sql_padded("key", 12)} AS txn_id,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(u_sec % {pay.FACT_DAYS * 86400}) AS txn_ts,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS amount,
  CASE WHEN {_FORCED} THEN '{ref.HOT_KEY[0]}' ELSE {sql_pick("u_mcc", [m[0] for m in ref.MCCS])} END AS mcc,
  CASE WHEN {_FORCED} THEN '{ref.HOT_KEY[1]}' ELSE {sql_pick_weighted("u_country", ref.COUNTRY_WEIGHTS)} END AS country_code,
  CASE WHEN {_FORCED} THEN '{ref.HOT_KEY[2]}' ELSE {sql_pick_weighted("u_entry", ref.ENTRY_WEIGHTS)} END AS entry_mode,
  {sql_pick_weighted("u_response", ref.RESPONSE_WEIGHTS)} AS response_code,
  {sql_pick_weighted("u_channel", ref.PAYMENT_CHANNELS)} AS channel
  FROM pay_draws)"""


def _sql_rates(weeks: int) -> str:
    n_m, n_c, n_e = len(ref.MCCS), len(ref.COUNTRIES), len(ref.ENTRY_MODES)
    per_week = n_m * n_c * n_e
    return f"""rate_digits AS (SELECT id, id // {per_week} AS w, (id // {n_c * n_e}) % {n_m} AS m,
  (id // {n_e}) % {n_c} AS c, id % {n_e} AS e FROM (SELECT unnest(range({weeks * per_week})) AS id)),
rates AS (SELECT 'IC' || {sql_padded("id + 1", 9)} AS rate_id,
  {sql_list([x[0] for x in ref.MCCS])}[1 + m] AS mcc,
  {sql_list([x[0] for x in ref.COUNTRIES])}[1 + c] AS country_code,
  {sql_list([x[0] for x in ref.ENTRY_MODES])}[1 + e] AS entry_mode,
  CAST(DATE '2024-01-01' + CAST(w * 7 AS INT) AS DATE) AS effective_from,
  CASE WHEN w = {weeks - 1} THEN DATE '2099-12-31'
       ELSE CAST(DATE '2024-01-01' + CAST(w * 7 + 6 AS INT) AS DATE) END AS effective_to,
  {sql_list([ref.BASE_BPS[x[2]] for x in ref.MCCS])}[1 + m] + {sql_list([ref.ENTRY_BPS[x[0]] for x in ref.ENTRY_MODES])}[1 + e]
    + {sql_list([ref.RISK_BPS[x[3]] for x in ref.COUNTRIES])}[1 + c] + w % 5 - 2 AS rate_bps,
  CAST((5 + (id + 1) % 8) AS DECIMAL(6,4)) * 0.001 AS fixed_fee
  FROM rate_digits)"""


RATES_SQL = _sql_rates(pay.RATE_WEEKS)

# Priced transactions: the plain statement of the question, whatever plan Spark uses.
PRICED_SQL = f"""{PAYMENTS_SQL},
{RATES_SQL},
priced AS (SELECT p.txn_id, p.txn_ts, p.country_code, p.entry_mode, p.mcc, p.amount, r.rate_id,
  round(CAST(p.amount * CAST(r.rate_bps AS DECIMAL(6,0)) * 0.0001 + r.fixed_fee AS DECIMAL(30,6)), 2) AS fee
  FROM payments p JOIN rates r ON p.mcc = r.mcc AND p.country_code = r.country_code
   AND p.entry_mode = r.entry_mode AND CAST(p.txn_ts AS DATE) BETWEEN r.effective_from AND r.effective_to
  WHERE p.response_code = '00')"""


# ---- Clickstream ----------------------------------------------------------------------


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks as campaign impressions."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    return e.select(
        F.col("event_id").cast("string").alias("impression_id"),
        F.col("user_id").cast("string").alias("visitor_id"),
        F.concat(F.lit("camp-"), (F.col("event_id") % 40).cast("string")).alias("campaign_id"),
        F.col("ts").cast("timestamp").alias("impression_ts"),
        F.col("event_type").alias("channel"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").cast("string").alias("purchase_id"),
        F.col("user_id").cast("string").alias("visitor_id"),
        (F.col("event_id") % 5000).cast("int").alias("product_id"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("ts").cast("timestamp").alias("purchase_ts"),
    )


CLICKS_SQL = """impressions AS (SELECT CAST(event_id AS VARCHAR) AS impression_id,
  CAST(user_id AS VARCHAR) AS visitor_id, 'camp-' || CAST(event_id % 40 AS VARCHAR) AS campaign_id,
  ts AS impression_ts FROM events WHERE event_type IN ('view', 'click')),
purchases AS (SELECT event_id, CAST(event_id AS VARCHAR) AS purchase_id,
  CAST(user_id AS VARCHAR) AS visitor_id, event_id % 5000 AS product_id,
  CAST(value AS DECIMAL(10,2)) AS amount, ts AS purchase_ts FROM events WHERE event_type = 'purchase')"""
