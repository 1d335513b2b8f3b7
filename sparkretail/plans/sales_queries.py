"""Retail queries over ``lineitem``, ``part``, ``orders`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.draws import pick_weighted, with_draws
from sparkretail.functions.money import units
from sparkretail.operators import aggregates, clean, compare, manifest, matching, ordering, windows
from sparkretail.plans import derive
from sparkretail.plans.derive import (
    CONTRIBUTION_SQL,
    LINES_SQL,
    MONEY_DIGITS,
    REVENUE_SQL,
    SALES_SQL,
    sql_draws,
    sql_list,
    sql_pick,
    sql_pick_weighted,
    table,
)
from sparkretail.session import fresh_path
from sparkretail.sources import sinks
from sparkretail.synth import reference_data as ref
from sparkretail.synth import sales as synth

DIRT_RATE, SEED = 0.12, 42
FLOOR_STORES, DECOY_STORES = (100, 139), (1, 30)
AUDIT_PRODUCTS = (7, 13, 19, 28, 31, 35, 38, 42)
SORTED_ROWS_PER_FILE = 1_000_000
CUSTOMER_STREAMS = {"u_who": 21, "u_tail": 22}
RUN_STREAMS = {"u_state": 23}

FLOOR_SQL = "channel = 'POS' AND status = 'COMPLETED'"


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    return derive.sales(spark, sf)


def _dirty(spark: SparkSession, sf: str, keep_kind: bool = False) -> DataFrame:
    # The cleaning rules expect a completed sale unless a defect says otherwise.
    completed = _sales(spark, sf).withColumn("status", F.lit("COMPLETED"))
    return synth.plant_dirt(completed, "key", DIRT_RATE, seed=SEED, keep_kind=keep_kind)


def _kind_streams(seed: int) -> dict[str, int]:
    return {"u_dirt": seed * 100 + 50, "u_kind": seed * 100 + 51, "u_value": seed * 100 + 52}


_IS_DIRTY = f"u_dirt % 10000 < {int(DIRT_RATE * 10000)}"
DIRTY_SQL = f"""{SALES_SQL},
{sql_draws("sales", "dirt_draws", "key", _kind_streams(SEED))},
kinds AS (SELECT *, CASE WHEN {_IS_DIRTY} THEN {sql_pick("u_kind", synth.DIRT_KINDS)} END AS kind FROM dirt_draws),
dirty AS (SELECT key, txn_id, kind, store_id, unit_price,
  CASE WHEN kind = 'null_product_id' THEN NULL ELSE product_id END AS product_id,
  CASE kind WHEN 'qty_zero' THEN 0 WHEN 'qty_100' THEN 100
    WHEN 'qty_negative' THEN CASE WHEN u_value % 2 = 0 THEN -5 ELSE -1 END
    WHEN 'qty_over' THEN u_value % 400 + 101 ELSE quantity END AS quantity,
  CASE WHEN kind = 'null_discount' THEN NULL ELSE discount_pct END AS discount_pct,
  CASE kind WHEN 'currency_usd_alias' THEN 'usd' WHEN 'currency_dollar' THEN '$'
    WHEN 'currency_null' THEN NULL WHEN 'currency_inr' THEN 'INR' ELSE currency END AS currency,
  CASE kind WHEN 'status_complete_alias' THEN 'complete' WHEN 'status_Complete' THEN 'Complete'
    WHEN 'status_cancelled' THEN 'CANCELLED' WHEN 'status_pending' THEN 'PENDING' ELSE 'COMPLETED' END AS status
  FROM kinds)"""


def line_revenue(spark: SparkSession, sf: str) -> DataFrame:
    priced = clean.add_line_revenue(_sales(spark, sf), precision=18)
    return priced.select("txn_id", "store_id", "revenue")


def clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean(_dirty(spark, sf)).select(
        "txn_id", "product_id", "quantity", "discount_pct", "currency", "status"
    )


def valid_line_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return clean.valid_line_revenue(_dirty(spark, sf)).select("txn_id", "quantity", "revenue")


def dirt_kinds(spark: SparkSession, sf: str) -> DataFrame:
    kinds = _dirty(spark, sf, keep_kind=True)
    return kinds.groupBy(F.coalesce("kind", F.lit("clean")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


EDGE_STREAMS = _kind_streams(SEED + 1)
TICKETS_SQL = f"""{SALES_SQL},
{sql_draws("sales", "edge_draws", "key", EDGE_STREAMS)},
edges AS (SELECT *, CASE WHEN u_dirt % 10000 < 1200 THEN {sql_pick("u_kind", synth.TICKET_EDGES)} ELSE '' END AS kind FROM edge_draws),
tickets AS (SELECT txn_id, store_id, product_id, quantity, currency, country_code,
  CASE WHEN kind IN ('not_pos', 'not_pos_dup') THEN {sql_pick("u_value", ("web", "app"))} ELSE channel END AS channel
  FROM edges)"""


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    return synth.plant_ticket_edges(_sales(spark, sf), "key", DIRT_RATE, seed=SEED)


def collapse_tickets(spark: SparkSession, sf: str) -> DataFrame:
    # Only columns that follow from the ticket id: which copy survives is not defined.
    return clean.collapse_tickets(_tickets(spark, sf)).select(
        "txn_id", "channel", "currency", "country_code"
    )


def collapse_tickets_ordered(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("quantity"), F.col("store_id"), F.col("product_id")]
    return clean.collapse_tickets_ordered(_tickets(spark, sf), order).select(
        "txn_id", "store_id", "product_id", "quantity"
    )


def _store_lake(spark: SparkSession, sf: str) -> DataFrame:
    return synth.store_floor_and_decoys(_sales(spark, sf), "key", FLOOR_STORES, DECOY_STORES, seed=SEED)


_LAKE = {"u_side": SEED * 100 + 60, "u_store": SEED * 100 + 61, "u_how": SEED * 100 + 62}
LAKE_SQL = f"""{LINES_SQL},
{sql_draws("lines", "lake_draws", "key", _LAKE)},
lake AS (SELECT CASE WHEN u_side % 100 < 82 THEN u_store % 40 + 100 ELSE u_store % 30 + 1 END AS store_id,
  u_side % 100 < 82 AS is_floor FROM lake_draws)"""


def store_list(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.store_list(_store_lake(spark, sf))


def floor_versus_lake(spark: SparkSession, sf: str) -> DataFrame:
    lake = _store_lake(spark, sf)
    return compare.floor_versus_lake(lake, clean.floor(lake), "store_id")


def distinct_store_payments(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_values(clean.floor(_sales(spark, sf)), ["store_id", "payment_method"])


def store_contribution(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.store_contribution(_sales(spark, sf), MONEY_DIGITS)


def store_payment_profile(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.store_payment_profile(_sales(spark, sf), MONEY_DIGITS)


def store_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.store_rollup(_sales(spark, sf), MONEY_DIGITS, with_level=True)
    return out.withColumn("store_id", F.col("store_id").cast("string"))


def store_segments(spark: SparkSession, sf: str) -> DataFrame:
    # Exact quartiles by a high accuracy; the distinct sketch is compared to the exact
    # count, five standard deviations apart would be an error.
    sales = _sales(spark, sf)
    exact = aggregates.store_distinct_customers(sales)
    close = F.abs(F.col("approx_unique_customers") - F.col("unique_customers")) <= (
        5 * aggregates.RSD * F.col("unique_customers")
    )
    return (
        aggregates.store_segments(sales, accuracy=1_000_000, precision=18)
        .join(exact, "store_id")
        .withColumn("approx_is_close", close.cast("int"))
        .drop("approx_unique_customers")
    )


def customer_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Half of all rows belong to one of a hundred customers."""
    drawn = with_draws(derive.lines(spark, sf), "key", CUSTOMER_STREAMS)
    who = F.when(F.col("u_who") % 100 < 50, F.lit(0)).otherwise(F.col("u_tail") % 99 + 1)
    tx = drawn.select(
        F.col("key").cast("string").alias("txn_id"), who.alias("customer_id"), "l_extendedprice"
    )
    return aggregates.customer_totals(
        tx, "customer_id", units("l_extendedprice", 2), precision=MONEY_DIGITS
    )


def run_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as benchmark runs: return flag as variant, quantity and tax as metrics."""
    drawn = with_draws(derive.lines(spark, sf), "key", RUN_STREAMS)
    state = pick_weighted(F.col("u_state"), [("COMPLETED", 9), ("FAILED", 1)])
    runs = drawn.select(
        F.col("l_returnflag").alias("variant"),
        state.alias("terminal_state"),
        F.col("l_quantity").cast("decimal(10,2)").alias("wall_clock_seconds"),
        F.when(F.col("l_linenumber") < 7, F.col("l_discount").cast("decimal(10,2)")).alias("skew_ratio"),
    )
    out = aggregates.run_statistics(runs, "variant", ["wall_clock_seconds", "skew_ratio"])
    # A mean may end in an exact half; two digits less are safe to compare.
    return out.withColumns({c: F.col(c).cast("decimal(12,2)") for c in out.columns if c.endswith(("_avg", "_min", "_max"))})


def audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    """What holds for any seeded draw: its seed, the floor, no row from outside, a size near a
    tenth, and the same rows when drawn again."""
    sales = _sales(spark, sf).withColumn("product_code", F.lit(None).cast("string"))
    envelopes = synth.audit_envelopes(sales, AUDIT_PRODUCTS)
    everything = sales.unionByName(envelopes)
    floor = clean.floor(everything).select("txn_id")
    sample = ordering.audit_sample(everything).select("txn_id")
    again = ordering.audit_sample(everything).select("txn_id")
    n, size = floor.count(), sample.count()
    outside = sample.join(floor, "txn_id", "left_anti").count()
    same = sample.exceptAll(again).count() + again.exceptAll(sample).count() == 0
    row = (ordering.audit_seed(everything), n, outside, int(abs(size - 0.1 * n) <= 5 * (0.09 * n) ** 0.5), int(same))
    names = "seed bigint, floor_rows bigint, outside bigint, size_within_5_sigma bigint, repeats bigint"
    return spark.createDataFrame([row], names)


def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.hash_sample(clean.floor(_sales(spark, sf)), "txn_id", 0.1, seed=7).select("txn_id", "store_id")


def _known_parts(spark: SparkSession, sf: str) -> DataFrame:
    # Every line has a part; keeping the small parts makes orphans.
    return table(spark, sf, "part").filter(F.col("p_size") <= 25).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


def orphan_sales(spark: SparkSession, sf: str) -> DataFrame:
    out = matching.orphans(_sales(spark, sf), _known_parts(spark, sf), ["product_id"])
    return out.select("txn_id", "product_id", "store_id", "quantity")


def matched_sales(spark: SparkSession, sf: str) -> DataFrame:
    out = matching.matched(_sales(spark, sf), _known_parts(spark, sf), ["product_id"])
    return out.select("txn_id", "product_id", "store_id", "quantity")


def orphan_sales_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the size check failing on purpose: the plan beyond broadcast."""
    out = matching.orphans(_sales(spark, sf), _known_parts(spark, sf), ["product_id"], max_bytes=0)
    return out.select("txn_id", "product_id", "store_id", "quantity")


def latest_order_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    latest = windows.latest_per_key(
        orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    )
    return latest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")


def sales_manifest(spark: SparkSession, sf: str) -> DataFrame:
    dirty = _dirty(spark, sf).select(
        "store_id", "product_id", "quantity", "discount_pct", "currency", "status"
    )
    conditions = {
        "qty_not_positive": F.col("quantity") <= 0,
        "qty_over": F.col("quantity") > 100,
        "completed": F.col("status") == "COMPLETED",
    }
    return manifest.manifest(dirty, conditions, distinct=["store_id", "currency"])


def synthetic_sales(spark: SparkSession, sf: str) -> DataFrame:
    made = synth.sales(derive.lines(spark, sf).select("key"), seed=SEED)
    return made.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("quantity").alias("quantity"),
        F.sum("unit_price").cast("decimal(24,2)").alias("unit_price"),
        F.sum("discount_pct").cast("decimal(24,2)").alias("discount_pct"),
        F.sum(F.hour("event_ts")).alias("hours"),
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def dataset_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy with lost, added, repeated, changed and slightly changed rows."""
    expected = _orders(spark, sf)
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    copies = F.when(k % 101 == 0, F.array().cast("array<int>")).when(
        k % 103 == 0, F.array(F.lit(0), F.lit(0))
    ).when(k % 107 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    actual = (
        expected.withColumn("copy", F.explode(copies))
        .withColumn("o_orderkey", F.when(F.col("copy") == 1, -k - 1).otherwise(k))
        .withColumn(
            "o_totalprice",
            F.when(k % 109 == 0, price + 1).when(k % 113 == 0, price + 0.004).otherwise(price),
        )
        .drop("copy")
    )
    diff = compare.keyed_diff(
        expected, actual, ["o_orderkey"], compare.Tolerance(absolute={"o_totalprice": 0.01})
    )
    return compare.diff_counts(diff)


def key_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of the BUILDING segment against the customers of urgent orders: keys that
    stand on one side only."""
    building = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return compare.key_diff(
        building.select(F.col("c_custkey").alias("custkey")),
        urgent.select(F.col("o_custkey").alias("custkey")),
        ["custkey"],
    )


def row_difference(spark: SparkSession, sf: str) -> DataFrame:
    """(part, quantity) of returned lines against accepted lines, with multiplicity."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_returnflag")
    r = lines.filter(F.col("l_returnflag") == "R").drop("l_returnflag")
    a = lines.filter(F.col("l_returnflag") == "A").drop("l_returnflag")
    return compare.row_diff(r, a)


def concat_parts(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_linestatus")
    parts = [lines.filter(F.col("l_linestatus") == s) for s in ("F", "O")]
    return compare.concat_parts(parts).groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


def sorted_export(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.col("value").alias("amount"), "user_id")
    path = fresh_path(spark, "sorted")
    n_files = max(1, -(-events.count() // SORTED_ROWS_PER_FILE))
    sinks.write_sorted(events, ordering.by_amount(), n_files, path)
    return spark.read.parquet(path)


def shuffled_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.shuffled(_orders(spark, sf), seed=SEED)


def parquet_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Replace-mode Parquet sink with row-group and rows-per-file limits, read back."""
    path = fresh_path(spark, "rewrite")
    sinks.write_table(
        _orders(spark, sf), path, row_group_bytes=64 * 1024 * 1024, max_records_per_file=250_000
    )
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"),
        (F.sum(units("o_totalprice", 2)).cast("decimal(20,0)") / 100).cast("decimal(24,2)").alias("total"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        line_revenue, clean_sales, valid_line_revenue, dirt_kinds, collapse_tickets,
        collapse_tickets_ordered, store_list, floor_versus_lake, distinct_store_payments,
        store_contribution, store_payment_profile, store_rollup, store_segments,
        customer_totals, run_statistics, audit_sample, hash_sample, orphan_sales,
        matched_sales, orphan_sales_salted, latest_order_per_customer, sales_manifest,
        synthetic_sales, dataset_diff, key_difference, row_difference, concat_parts,
        sorted_export, shuffled_rows, parquet_rewrite,
    )
}

_ORPHANS_SQL = f"""WITH {SALES_SQL}
SELECT txn_id, product_id, store_id, quantity FROM sales s
WHERE {{}}EXISTS (SELECT 1 FROM part WHERE p_size <= 25 AND p_partkey = s.product_id)"""

_MANIFEST_ITEMS = {
    "rows": "count(*)",
    "qty_not_positive": "count(*) FILTER (quantity <= 0)",
    "qty_over": "count(*) FILTER (quantity > 100)",
    "completed": "count(*) FILTER (status = 'COMPLETED')",
    "distinct_store_id": "count(DISTINCT store_id)",
    "distinct_currency": "count(DISTINCT currency)",
} | {
    f"null_{c}": f"count(*) FILTER ({c} IS NULL)"
    for c in ("store_id", "product_id", "quantity", "discount_pct", "currency", "status")
}

_SYNTH = {s: SEED * 100 + i for i, s in enumerate(
    ("store", "register", "product", "customer", "qty", "price", "disc", "cur", "chan", "pay", "ctry", "sec")
)}
_SYNTH_STREAMS = {f"u_{s}": _SYNTH[s] for s in ("store", "qty", "price", "disc", "sec")}

ORACLES = {
    "line_revenue": f"WITH {SALES_SQL} SELECT txn_id, store_id, CAST({REVENUE_SQL} AS DOUBLE) AS revenue FROM sales",
    "clean_sales": f"""WITH {DIRTY_SQL},
mapped AS (SELECT txn_id, product_id, quantity, coalesce(discount_pct, 0) AS discount_pct,
  coalesce(CASE WHEN currency IN ('usd', '$') THEN 'USD' ELSE currency END, 'USD') AS currency,
  CASE WHEN status IN ('complete', 'Complete') THEN 'COMPLETED' ELSE status END AS status FROM dirty)
SELECT txn_id, product_id, quantity, CAST(discount_pct AS DOUBLE) AS discount_pct, currency, status FROM mapped
WHERE product_id IS NOT NULL AND quantity > 0 AND quantity <= 100
  AND currency IN ('USD', 'EUR', 'GBP') AND status = 'COMPLETED'""",
    "valid_line_revenue": f"""WITH {DIRTY_SQL}
SELECT txn_id, quantity, CAST({REVENUE_SQL} AS DOUBLE) AS revenue FROM dirty
WHERE quantity > 0 AND quantity <= 100 AND currency IN ('USD', 'EUR', 'GBP') AND status = 'COMPLETED'""",
    "dirt_kinds": f"WITH {DIRTY_SQL} SELECT coalesce(kind, 'clean') AS kind, count(*) AS n_rows FROM dirty GROUP BY 1",
    "collapse_tickets": f"WITH {TICKETS_SQL} SELECT DISTINCT txn_id, channel, currency, country_code FROM tickets WHERE channel = 'POS'",
    "collapse_tickets_ordered": f"""WITH {TICKETS_SQL}
SELECT txn_id, store_id, product_id, quantity FROM tickets WHERE channel = 'POS'
QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY quantity, store_id, product_id) = 1""",
    "store_list": f"WITH {LAKE_SQL} SELECT DISTINCT store_id FROM lake WHERE is_floor ORDER BY store_id LIMIT 12",
    "floor_versus_lake": f"""WITH {LAKE_SQL} SELECT DISTINCT store_id FROM lake
WHERE store_id NOT IN (SELECT store_id FROM lake WHERE is_floor)""",
    "distinct_store_payments": f"WITH {SALES_SQL} SELECT DISTINCT store_id, payment_method FROM sales WHERE {FLOOR_SQL}",
    "store_contribution": f"""WITH {SALES_SQL}
SELECT store_id, CAST(sum({CONTRIBUTION_SQL}) AS DOUBLE) AS total_contribution, count(*) AS ticket_count
FROM sales WHERE hour(event_ts) >= 9 AND hour(event_ts) < 21 GROUP BY store_id""",
    "store_payment_profile": f"""WITH {SALES_SQL}
SELECT store_id, array_to_string(list_sort(list(DISTINCT payment_method)), ',') AS payment_methods,
  CAST(sum({REVENUE_SQL}) AS DOUBLE) AS total_revenue, count(*) AS ticket_count,
  count(DISTINCT payment_method) AS payment_variety
FROM sales WHERE {FLOOR_SQL} GROUP BY store_id""",
    "store_rollup": f"""WITH {SALES_SQL}
SELECT CAST(store_id AS VARCHAR) AS store_id, payment_method,
  CAST(sum({REVENUE_SQL}) AS DOUBLE) AS total_revenue, count(*) AS ticket_count,
  CAST(grouping(store_id, payment_method) AS BIGINT) AS level
FROM sales WHERE {FLOOR_SQL} GROUP BY ROLLUP (store_id, payment_method)""",
    "store_segments": f"""WITH {SALES_SQL},
floor AS (SELECT store_id, customer_id, {REVENUE_SQL} AS revenue FROM sales
  WHERE channel IN ('POS', 'ONLINE') AND status = 'COMPLETED')
SELECT store_id, CAST(quantile_disc(revenue, 0.25) AS DOUBLE) AS revenue_p25,
  CAST(quantile_disc(revenue, 0.5) AS DOUBLE) AS revenue_p50,
  CAST(quantile_disc(revenue, 0.75) AS DOUBLE) AS revenue_p75,
  count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
  CAST(1 AS BIGINT) AS approx_is_close
FROM floor GROUP BY store_id""",
    "customer_totals": f"""WITH {LINES_SQL},
{sql_draws("lines", "d", "key", CUSTOMER_STREAMS)},
tx AS (SELECT CASE WHEN u_who % 100 < 50 THEN 0 ELSE u_tail % 99 + 1 END AS customer_id,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS amount FROM d)
SELECT customer_id, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
  CAST(CAST((CAST(sum(amount) * 100 AS BIGINT) * 2 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS DOUBLE) AS avg_amount
FROM tx GROUP BY customer_id""",
    "run_statistics": f"""WITH {LINES_SQL},
{sql_draws("lines", "d", "key", RUN_STREAMS)},
runs AS (SELECT l_returnflag AS variant, {sql_pick_weighted("u_state", [("COMPLETED", 9), ("FAILED", 1)])} AS state,
  CAST(l_quantity * 100 AS BIGINT) AS w,
  CASE WHEN l_linenumber < 7 THEN CAST(round(l_discount * 100) AS BIGINT) END AS s FROM d)
SELECT variant, count(*) AS completed_runs,
  CAST((sum(w) * 2 + count(w)) // (2 * count(w)) AS DOUBLE) / 100 AS wall_clock_seconds_avg,
  CAST(min(w) AS DOUBLE) / 100 AS wall_clock_seconds_min, CAST(max(w) AS DOUBLE) / 100 AS wall_clock_seconds_max,
  CAST((sum(s) * 2 + count(s)) // (2 * count(s)) AS DOUBLE) / 100 AS skew_ratio_avg,
  CAST(min(s) AS DOUBLE) / 100 AS skew_ratio_min, CAST(max(s) AS DOUBLE) / 100 AS skew_ratio_max
FROM runs WHERE state = 'COMPLETED' GROUP BY variant""",
    "audit_sample": f"""WITH {SALES_SQL} SELECT CAST({max(AUDIT_PRODUCTS)} AS BIGINT) AS seed, count(*) AS floor_rows,
  CAST(0 AS BIGINT) AS outside, CAST(1 AS BIGINT) AS size_within_5_sigma, CAST(1 AS BIGINT) AS repeats
FROM sales WHERE {FLOOR_SQL}""",
    "hash_sample": f"""WITH {SALES_SQL} SELECT txn_id, store_id FROM sales
WHERE {FLOOR_SQL} AND substr(md5('7:' || txn_id), 1, 8) < '{format(int(0.1 * 16**8), "08x")}'""",
    "orphan_sales": _ORPHANS_SQL.format("NOT "),
    "orphan_sales_salted": _ORPHANS_SQL.format("NOT "),
    "matched_sales": _ORPHANS_SQL.format(""),
    "latest_order_per_customer": """SELECT o_custkey, o_orderkey,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "sales_manifest": f"WITH {DIRTY_SQL} "
    + " UNION ALL ".join(f"SELECT '{k}' AS item, {v} AS value FROM dirty" for k, v in _MANIFEST_ITEMS.items()),
    "synthetic_sales": f"""WITH {LINES_SQL},
{sql_draws("lines", "d", "key", _SYNTH_STREAMS)}
SELECT u_store % 50 + 1 AS store_id, count(*) AS n_rows, CAST(sum(u_qty % 99 + 1) AS BIGINT) AS quantity,
  CAST(sum(CAST(u_price % 9900 + 100 AS DECIMAL(18,2)) * 0.01) AS DOUBLE) AS unit_price,
  CAST(sum(CAST(u_disc % 51 AS DECIMAL(18,2)) * 0.01) AS DOUBLE) AS discount_pct,
  CAST(sum(9 + (u_sec % 43200) // 3600) AS BIGINT) AS hours
FROM d GROUP BY 1""",
    "dataset_diff": """WITH actual AS (
  SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 109 = 0 THEN 1 ELSE 0 END AS p FROM orders WHERE o_orderkey % 101 <> 0
  UNION ALL SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 109 = 0 THEN 1 ELSE 0 END FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 = 0
  UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0 AND o_orderkey % 107 = 0),
a AS (SELECT k, count(*) AS n, min(p) AS p FROM actual GROUP BY k),
e AS (SELECT o_orderkey AS k, count(*) AS n, min(o_totalprice) AS p FROM orders GROUP BY 1)
SELECT CASE WHEN coalesce(e.n, 0) > 1 OR coalesce(a.n, 0) > 1 THEN 'duplicate' WHEN a.n IS NULL THEN 'missing'
  WHEN e.n IS NULL THEN 'extra' WHEN abs(a.p - e.p) > 0.5 THEN 'mismatch' ELSE 'equal' END AS verdict, count(*) AS n_keys
FROM e FULL OUTER JOIN a ON e.k = a.k GROUP BY 1""",
    "key_difference": """WITH b AS (SELECT DISTINCT c_custkey AS custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
u AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT custkey, 'missing' AS verdict FROM b WHERE custkey NOT IN (SELECT custkey FROM u)
UNION ALL SELECT custkey, 'extra' FROM u WHERE custkey NOT IN (SELECT custkey FROM b)""",
    "row_difference": """SELECT l_partkey, l_quantity,
  CAST(sum(CASE l_returnflag WHEN 'R' THEN 1 ELSE -1 END) AS BIGINT) AS surplus
FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1, 2
HAVING sum(CASE l_returnflag WHEN 'R' THEN 1 ELSE -1 END) <> 0""",
    "concat_parts": "SELECT l_linestatus, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1",
    "sorted_export": "SELECT event_id, value AS amount, user_id FROM events",
    "shuffled_rows": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "parquet_rewrite": """SELECT o_orderstatus, count(*) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
}
