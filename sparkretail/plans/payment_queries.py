"""Settlement queries: payments derived from ``lineitem`` against the weekly rate card."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.dates import month_text
from sparkretail.functions.draws import fenced
from sparkretail.operators import manifest, pricing, settlement
from sparkretail.plans import derive
from sparkretail.plans.derive import PAYMENTS_SQL, PRICED_SQL
from sparkretail.session import fresh_path, profiled
from sparkretail.sources import readers, sinks
from sparkretail.synth import payments as pay
from sparkretail.synth import reference_data as ref

ENTRY_SCHEMA = (
    "country_code STRING, entry_mode STRING, txn_count BIGINT, total_fee DECIMAL(18,2), "
    "distinct_rate_versions_used BIGINT"
)
MONTH_SCHEMA = (
    "country_code STRING, txn_month STRING, approved_gmv DECIMAL(18,2), "
    "interchange_fee_total DECIMAL(18,2), review_txns BIGINT"
)


def priced(spark: SparkSession, sf: str, strategy: str = "auto") -> DataFrame:
    fact = pricing.approved(derive.payments(spark, sf))
    return pricing.price(
        fact, pay.rate_card(spark), strategy, window=pay.FACT_WINDOW, hot=[ref.HOT_KEY]
    )


def month_rollup(strategy: str, spark: SparkSession, sf: str) -> DataFrame:
    """The month report under a plan. The adaptive plan needs settings of its own (sort-merge
    join, split skewed partitions): its report is written under them and read back."""
    if strategy != "aqe":
        return settlement.settle_by_month(priced(spark, sf, strategy))
    path = fresh_path(spark, "price-aqe")
    settlement.settle_by_month(priced(profiled(spark, "skew_aqe"), sf, strategy)).write.parquet(path)
    return spark.read.parquet(path)


def settle_by_entry(spark: SparkSession, sf: str) -> DataFrame:
    return settlement.settle_by_entry(priced(spark, sf))


def settle_by_entry_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The published plan of this report: fact salted by transaction id."""
    return settlement.settle_by_entry(priced(spark, sf, "salted"))


def priced_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = pricing.priced_rows(priced(spark, sf))
    return rows.select("txn_id", "rate_id", "amount", "interchange_fee")


def priced_totals(spark: SparkSession, sf: str) -> DataFrame:
    return settlement.row_totals(priced(spark, sf))


def strategy_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """Check totals under every plan; all rows must agree."""
    return settlement.strategy_totals(
        {s: month_rollup(s, spark, sf) for s in pricing.STRATEGIES}
    )


def isolate_detected(spark: SparkSession, sf: str) -> DataFrame:
    """Hot-key isolation with the hot keys found by counting."""
    fact = pricing.approved(derive.payments(spark, sf))
    rows = pricing.price(fact, pay.rate_card(spark), "isolate", window=pay.FACT_WINDOW)
    return settlement.settle_by_month(rows)


def auto_beyond_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """The default plan with the size check failing on purpose: hot keys are salted."""
    fact = pricing.approved(derive.payments(spark, sf))
    rows = pricing.price(fact, pay.rate_card(spark), "auto", window=pay.FACT_WINDOW, max_bytes=0)
    return settlement.settle_by_month(rows)


def settlement_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Single-file CSV of the entry-mode report, read back under its declared schema."""
    path = fresh_path(spark, "settlement-csv")
    sinks.write_small_csv(settle_by_entry(spark, sf), path)
    return readers.read_csv(spark, path, ENTRY_SCHEMA)


def settlement_json_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Single-file JSON of the month report; check totals come from the written file."""
    path = fresh_path(spark, "settlement-json")
    sinks.write_small_json(month_rollup("auto", spark, sf), path)
    return settlement.month_totals(readers.read_json(spark, path, MONTH_SCHEMA))


def partitioned_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Folders per country and month, read back. One country holds most rows, so its
    folders are written by several tasks."""
    fact = derive.payments(spark, sf).select(
        "txn_id", "amount", "country_code",
        month_text(F.trunc(F.to_date("txn_ts"), "month")).alias("txn_month"),
    )
    path = fresh_path(spark, "by-country-month")
    sinks.write_partitioned(fact, ["country_code", "txn_month"], path)
    back = spark.read.schema("txn_id STRING, amount DOUBLE, country_code STRING, txn_month STRING").parquet(path)
    return back.groupBy("country_code", "txn_month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.rint(F.col("amount") * 100).cast("bigint")).alias("cents"),
    )


def payments_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Shares the generator promises: hot key, approvals, cross-border, settled."""
    columns = (
        "channel", "mcc", "country_code", "entry_mode", "response_code", "merchant_country",
        "settled", "auth_code",
    )
    fact = derive.payments(spark, sf, columns)
    is_hot = pricing.is_key(ref.HOT_KEY)
    return fact.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_hot).alias("hot_key"),
        F.count_if(F.col("response_code") == pricing.APPROVED).alias("approved"),
        F.count_if(F.col("merchant_country") != F.col("country_code")).alias("cross_border"),
        F.count_if("settled").alias("settled"),
        F.count_if(F.length("auth_code") == 6).alias("authorised"),
    )


def payment_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts as the generator draws them (log-normal cents), per currency."""
    made = pay.payments(derive.payment_keys(spark, sf), hot_mcc_share=0.9, wide=False)
    return made.groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("mcc") == ref.HOT_KEY[0]).alias("hot_mcc"),
        F.sum("amount").cast("decimal(24,2)").alias("amount"),
        F.count_distinct("card_token").alias("cards"),
    )


def invalid_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Card numbers with a broken check digit in every fiftieth row, counted per country."""
    keyed = derive.payment_keys(spark, sf)
    made = pay.payments(
        keyed, hot_share=derive.HOT_SHARE, keep=("key",), columns=("country_code", "card_number")
    )
    fact = fenced(made, {"card_number": F.col("card_number")})
    digit = F.substring("card_number", -1, 1).cast("int")
    broken = F.concat(F.substring("card_number", 1, 15), ((digit + 1) % 10).cast("string"))
    number = F.when(F.col("key") % 50 == 0, broken).otherwise(F.col("card_number"))
    spoiled = fenced(fact, {"card_number": number})
    return manifest.invalid_cards(spoiled, ["country_code"])


QUERIES = {f"price_{s}": partial(month_rollup, s) for s in pricing.STRATEGIES}
for _name, _query in QUERIES.items():
    _query.__name__ = _name
QUERIES |= {
    f.__name__: f
    for f in (
        settle_by_entry, settle_by_entry_salted, priced_rows, priced_totals,
        strategy_equivalence, isolate_detected, auto_beyond_broadcast, settlement_csv,
        settlement_json_totals, partitioned_layout, payments_profile, payment_amounts,
        invalid_cards,
    )
}

MONTH_SQL = f"""WITH {PRICED_SQL}
SELECT country_code, strftime(txn_ts, '%Y-%m') AS txn_month, CAST(sum(amount) AS DOUBLE) AS approved_gmv,
  CAST(sum(fee) AS DOUBLE) AS interchange_fee_total, count(*) FILTER (fee > 0.25) AS review_txns
FROM priced GROUP BY 1, 2"""

ENTRY_SQL = f"""WITH {PRICED_SQL}
SELECT country_code, entry_mode, count(*) AS txn_count, CAST(sum(fee) AS DOUBLE) AS total_fee,
  count(DISTINCT rate_id) AS distinct_rate_versions_used FROM priced GROUP BY 1, 2"""

TOTALS_SQL = f"""totals AS (SELECT count(DISTINCT country_code || strftime(txn_ts, '%Y-%m')) AS groups,
  CAST(sum(amount) AS DOUBLE) AS gmv, CAST(sum(fee) AS DOUBLE) AS fee,
  count(*) FILTER (fee > 0.25) AS review_txns FROM priced)"""

_ABROAD = f"(u_cross % 100 < 12 AND {derive.sql_pick('u_alt', [c[0] for c in ref.COUNTRIES])} <> country_code)"
_OTHER_MCCS = [m[0] for m in ref.MCCS if m[0] != ref.HOT_KEY[0]]
_CURRENCY = "CASE country_code" + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in ref.COUNTRY_CURRENCY.items()) + " END"

ORACLES = {f"price_{s}": MONTH_SQL for s in pricing.STRATEGIES} | {
    "isolate_detected": MONTH_SQL,
    "auto_beyond_broadcast": MONTH_SQL,
    "settle_by_entry": ENTRY_SQL,
    "settle_by_entry_salted": ENTRY_SQL,
    "settlement_csv": ENTRY_SQL,
    "priced_rows": f"""WITH {PRICED_SQL} SELECT txn_id, rate_id, CAST(amount AS DOUBLE) AS amount,
  CAST(fee AS DOUBLE) AS interchange_fee FROM priced""",
    "priced_totals": f"WITH {PRICED_SQL} SELECT count(*) AS priced_rows, CAST(sum(fee) AS DOUBLE) AS fee_total FROM priced",
    "settlement_json_totals": f"WITH {PRICED_SQL}, {TOTALS_SQL} SELECT * FROM totals",
    "strategy_equivalence": f"""WITH {PRICED_SQL}, {TOTALS_SQL}
SELECT s.strategy, t.* FROM (SELECT unnest({derive.sql_list(pricing.STRATEGIES)}) AS strategy) s, totals t""",
    "partitioned_layout": f"""WITH {PAYMENTS_SQL}
SELECT country_code, strftime(txn_ts, '%Y-%m') AS txn_month, count(*) AS n_rows,
  CAST(sum(amount) * 100 AS BIGINT) AS cents FROM payments GROUP BY 1, 2""",
    "payments_profile": f"""WITH {PAYMENTS_SQL}
SELECT channel, count(*) AS n_rows,
  count(*) FILTER (mcc = '{ref.HOT_KEY[0]}' AND country_code = '{ref.HOT_KEY[1]}' AND entry_mode = '{ref.HOT_KEY[2]}') AS hot_key,
  count(*) FILTER (response_code = '00') AS approved,
  count(*) FILTER {_ABROAD} AS cross_border,
  count(*) FILTER (response_code = '00' AND u_settled % 100 < 94) AS settled,
  count(*) FILTER (response_code = '00') AS authorised FROM payments GROUP BY 1""",
    "payment_amounts": f"""WITH {derive.LINES_SQL},
{derive.sql_draws("lines", "d", "key", pay.STREAMS)},
made AS (SELECT {derive.sql_pick_weighted("u_country", ref.COUNTRY_WEIGHTS)} AS country_code,
  CASE WHEN u_hot_mcc % 1000000 < 900000 THEN '{ref.HOT_KEY[0]}' ELSE {derive.sql_pick("u_mcc", _OTHER_MCCS)} END AS mcc,
  u_card % 80000 AS card,
  least(greatest(CAST(floor(exp(6.5 + 1.1 * (sqrt(-2.0 * ln(CAST(u_n1 AS DOUBLE) / 2147483647.0))
    * cos(2 * pi() * (CAST(u_n2 AS DOUBLE) / 2147483647.0))))) AS BIGINT), 1), 5000000) AS cents FROM d)
SELECT {_CURRENCY} AS currency_code, count(*) AS n_rows, count(*) FILTER (mcc = '{ref.HOT_KEY[0]}') AS hot_mcc,
  CAST(CAST(sum(cents) AS DECIMAL(24,2)) * 0.01 AS DOUBLE) AS amount, count(DISTINCT card) AS cards
FROM made GROUP BY 1""",
    "invalid_cards": f"""WITH {PAYMENTS_SQL} SELECT country_code, count(*) AS cards,
  count(*) FILTER (key % 50 = 0) AS invalid_cards FROM payments GROUP BY 1""",
}
