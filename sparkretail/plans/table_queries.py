"""Queries that maintain tables: merges with versions, running values, rewritten folders,
and event streams with state."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.dates import epoch_micros
from sparkretail.operators import gate, hash_tree, running, sketches, versions
from sparkretail.plans.derive import table
from sparkretail.session import fresh_path, profiled
from sparkretail.sources import colocated, compaction, readers, sinks
from sparkretail.streaming import attribution, events

PARTS = versions.Layout(keys=["part_id"], tracked=["brand", "size"], latest=["cents"], buckets=8)
SLICES, LATE_BY, WIDTH, DELAY = 6, 3, 3_600, 600
ROWS_PER_FILE = 1_000_000


def _change(rows: DataFrame, part_id: str, brand: str, size: str, factor: int, day: str, deleted: str) -> DataFrame:
    return rows.select(
        F.expr(part_id).cast("bigint").alias("part_id"), F.expr(brand).alias("brand"), F.expr(size).cast("bigint").alias("size"),
        (F.round(F.col("p_retailprice") * 100).cast("bigint") * factor).alias("cents"),
        F.expr(f"to_date({day})").alias("changed_at"), F.expr(deleted).alias("deleted"),
    )


def _part_changes(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three change sets: all parts; changed, repeated, deleted and new ones; and then
    corrections, of which some are late and some come twice."""
    part = table(spark, sf, "part")
    third, fourth = part.where("p_partkey % 3 = 0"), part.where("p_partkey % 4 = 0")
    new = part.where("p_partkey % 17 = 0 AND p_partkey > 0")
    brand = "CASE WHEN p_partkey % 2 = 0 THEN 'Brand#99' ELSE p_brand END"
    size = "p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END"
    late = "CASE WHEN p_partkey % 28 = 0 THEN '2024-01-15' ELSE '2024-03-01' END"
    last = _change(
        fourth, "p_partkey", "p_brand", "p_size + CASE WHEN p_partkey % 28 = 0 THEN 7 ELSE 0 END", 3, late, "p_partkey % 44 = 0"
    )
    return [
        _change(part, "p_partkey", "p_brand", "p_size", 1, "'2024-01-01'", "false"),
        _change(third, "p_partkey", brand, size, 2, "'2024-02-01'", "p_partkey % 21 = 0").unionByName(
            _change(new, "-p_partkey", "p_brand", "p_size", 1, "'2024-02-01'", "false")
        ),
        last.unionByName(last.where("part_id % 8 = 0")),
    ]


def part_versions(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of every part after two merges, the last of which is repeated."""
    first, second, third = _part_changes(spark, sf)
    path = fresh_path(spark, "part-versions")
    versions.create(first, path, PARTS)
    for changes in (second, third, third):
        versions.merge(spark, path, changes, PARTS)
    return spark.read.parquet(path).select("part_id", "brand", "size", "cents", "valid_from", "valid_to")


def part_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest state of every part that is not deleted, after the same merges."""
    first, second, third = _part_changes(spark, sf)
    path = fresh_path(spark, "part-latest")
    versions.create_latest(first, path, PARTS)
    for changes in (second, third, third):
        versions.upsert(spark, path, changes, PARTS)
    return versions.live(spark, path, PARTS)


def customer_running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals and neighbours of every order per customer. Every second order is
    given to one customer, whose orders are cut into pieces."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    found = running.running(
        orders, ["customer_id"], ["day", "o_orderkey"], totals={"running_cents": "cents"}, number="n_orders",
        previous={"cents_before": "cents"}, following={"next_day": "day"},
    )
    return found.select("o_orderkey", "customer_id", "running_cents", "n_orders", "cents_before", "next_day")


def ranked_export(spark: SparkSession, sf: str) -> DataFrame:
    """Events in a sorted export, with their place in it."""
    ranked = running.global_rank(
        table(spark, sf, "events").select("event_id", (-F.col("value")).alias("below"), "value"), ["below", "event_id"]
    )
    path = fresh_path(spark, "ranked-export")
    files = max(1, math.ceil(readers.scalar(ranked.agg(F.count(F.lit(1)))) / ROWS_PER_FILE))
    sinks.write_sorted(ranked, [F.col("rank")], files, path)
    return spark.read.parquet(path).select("event_id", "rank", "value")


def rewritten_month(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in monthly folders, of which one is corrected and written again, twice."""
    orders = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    path = fresh_path(spark, "monthly-orders")
    sinks.write_partitioned(orders, ["month"], path)
    last = readers.scalar(orders.agg(F.max("month")))
    fixed = orders.where(F.col("month") == last).where("o_orderkey % 10 <> 0").withColumn("cents", F.col("cents") + 100)
    for _ in range(2):
        sinks.overwrite_partitions(fixed, ["month"], path)
    written = spark.read.schema("o_orderkey bigint, cents bigint, month string").parquet(path)
    return written.groupBy("month").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents"))


def _line_rules() -> dict[str, Column]:
    return {
        "quantity": F.col("l_quantity").between(1, 45),
        "discount": F.col("l_discount") <= 0.08,
        "ship_date": F.col("l_shipdate") >= F.to_timestamp(F.lit("1993-01-01")),
        "price": F.col("l_extendedprice") > 1000,
    }


def quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that keep all rules and lines that break some, written by one job; the counts
    the job made on the way, beside those of what it wrote."""
    lines = table(spark, sf, "lineitem")
    path = fresh_path(spark, "gate")
    seen = gate.split_valid(lines, _line_rules(), path)
    bad = gate.quarantined_rows(lines, path, _line_rules())
    by_rule = bad.select(F.explode("broken").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("written"))
    total = gate.valid_rows(lines, path).agg(F.count(F.lit(1)).alias("written")).select(F.lit("valid_rows").alias("item"), "written")
    observed = spark.createDataFrame(sorted(seen.items()), "item string, observed bigint")  # a row per rule
    return total.unionByName(by_rule).join(F.broadcast(observed), "item").select("item", "written", "observed")


SMALL_FILES, COMPACT_BYTES = 12, 64 << 20


def compacted_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in folders of many small files, packed into fewer; rows, old and new files."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), "o_orderstatus"
    )
    path = fresh_path(spark, "small-files")
    orders.repartition(SMALL_FILES, "o_orderkey").write.partitionBy("o_orderstatus").parquet(path)
    spread = compaction.compact(spark, path, ["o_orderstatus"], COMPACT_BYTES).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("old_files")
    )
    written = spark.read.schema(orders.schema).parquet(path)
    left = compaction.file_sizes(written, ["o_orderstatus"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("files"))
    totals = written.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents"))
    return totals.join(left, "o_orderstatus").join(spread, "o_orderstatus", "left").select(
        "o_orderstatus", "n_orders", "cents", (F.col("files") < F.col("old_files")).alias("fewer_files")
    )


BUCKETS = 8


def colocated_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and their lines joined bucket by bucket, per status."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderstatus")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    path = fresh_path(spark, "colocated")
    with colocated.bucketed([orders, lines], ["order_id"], BUCKETS) as (left, right):
        left.join(right.hint("merge"), "order_id").groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum("cents").alias("cents")
        ).write.parquet(path)
    return spark.read.parquet(path)


def customers_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers per month from daily sketches, against the exact number."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey"
    )
    path = fresh_path(spark, "daily-sketches")
    sketches.sketched(orders, ["month", "day"], F.col("o_custkey")).write.parquet(path)
    monthly = sketches.estimated(sketches.merged(spark.read.parquet(path), ["month"]), "estimate")
    exact = orders.groupBy("month").agg(F.count_distinct("o_custkey").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers"))
    return exact.join(monthly, "month").select(
        "month", "customers", (off <= 4 * sketches.relative_error() * F.col("customers")).alias("close")
    )


def tree_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy in which some are missing, new, repeated or changed."""
    key, total = F.col("o_orderkey"), F.col("o_totalprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    copy = orders.where("o_orderkey % 101 <> 0").select(
        F.when(key % 103 == 0, -key - 1).otherwise(key).alias("o_orderkey"),
        F.when(key % 107 == 0, total + 5).when(key % 109 == 0, total + 0.25).otherwise(total).alias("o_totalprice"),
        F.when(key % 113 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority",
    )
    copy = copy.unionByName(copy.where("o_orderkey % 127 = 0"))
    return hash_tree.tree_diff(orders, copy, ["o_orderkey"], absolute={"o_totalprice": 0.5})


# ---- streams ---------------------------------------------------------------------------


def _events_in_slices(spark: SparkSession, sf: str) -> tuple[DataFrame, int, int]:
    """Events with ``slice``, a sixth of their time span; the span of a slice in
    microseconds, and the files a slice needs."""
    rows = table(spark, sf, "events").select(
        "event_id", "ts", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    micros = epoch_micros(F.col("ts"))
    low, high, n = rows.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    span = (high - low) // SLICES + 1
    place: Column = F.floor((micros - low) / span).cast("int")
    return rows.withColumn("slice", place), span, max(1, math.ceil(n / SLICES / ROWS_PER_FILE))


EVENTS = "event_id bigint, ts timestamp, event_type string, cents bigint"


def stream_windowed_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly totals by event type from a stream in which every seventh event comes three
    slices late, after its hour was closed."""
    rows, _, files = _events_in_slices(spark, sf)
    late = (F.col("event_id") % 7 == 0) & (F.col("slice") + LATE_BY < SLICES)
    base = fresh_path(spark, "windowed")
    arriving = rows.withColumn("slice", F.when(late, F.col("slice") + LATE_BY).otherwise(F.col("slice")))
    attribution.write_slices(arriving, "slice", SLICES, f"{base}/in", files)
    stream = readers.stream_files(profiled(spark, "streaming"), f"{base}/in", EVENTS, files)
    totals = events.windowed_totals(
        stream, "ts", ["event_type"], f"{WIDTH} seconds", f"{DELAY} seconds", {"cents": "cents"}
    )
    events.drain(totals, f"{base}/out", f"{base}/checkpoint", spark.sparkContext.defaultParallelism)
    found = spark.read.schema(totals.schema).parquet(f"{base}/out")
    return found.select(epoch_micros(F.col("start")).alias("start_us"), "event_type", "n_rows", "cents")


def stream_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Events of which every third comes again a slice later. The stream is stopped half
    way and goes on from its checkpoint, where it still knows what it has seen."""
    rows, span, files = _events_in_slices(spark, sf)
    again = rows.where("event_id % 3 = 0").withColumn("slice", F.least(F.col("slice") + 1, F.lit(SLICES - 1)))
    arriving = rows.unionByName(again)
    base = fresh_path(spark, "arrivals")
    own = profiled(spark, "streaming")
    half = SLICES // 2
    for part in range(2):
        chosen = arriving.where(F.floor(F.col("slice") / half) == part).withColumn("slice", F.col("slice") % half)
        attribution.write_slices(chosen, "slice", half, f"{base}/in", files, append=part > 0)
        stream = readers.stream_files(own, f"{base}/in", EVENTS, files)
        first = events.first_arrivals(stream, "ts", ["event_id"], f"{2 * span // 1_000_000 + 1} seconds")
        events.drain(first, f"{base}/out", f"{base}/checkpoint", spark.sparkContext.defaultParallelism)
    found = spark.read.schema(first.schema).parquet(f"{base}/out")
    return found.select("event_id", "event_type", "cents")


QUERIES = {
    f.__name__: f
    for f in (
        part_versions, part_latest, customer_running_totals, ranked_export, rewritten_month,
        quarantined_lines, compacted_orders, colocated_orders, customers_by_month, tree_difference,
        stream_windowed_totals, stream_first_arrivals,
    )
}

_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"
_CHANGES_SQL = f"""changes AS (
  SELECT 1 AS set_no, p_partkey AS part_id, p_brand AS brand, CAST(p_size AS BIGINT) AS size, {_CENTS} AS cents,
    DATE '2024-01-01' AS since, false AS gone FROM part
  UNION ALL SELECT 2, p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Brand#99' ELSE p_brand END,
    p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END, 2 * {_CENTS}, DATE '2024-02-01', p_partkey % 21 = 0
    FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 2, -p_partkey, p_brand, p_size, {_CENTS}, DATE '2024-02-01', false FROM part WHERE p_partkey % 17 = 0 AND p_partkey > 0
  UNION ALL SELECT 3, p_partkey, p_brand, p_size + CASE WHEN p_partkey % 28 = 0 THEN 7 ELSE 0 END, 3 * {_CENTS},
    CASE WHEN p_partkey % 28 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END, p_partkey % 44 = 0
    FROM part WHERE p_partkey % 4 = 0)"""

_ORDERS_SQL = """orders2 AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey END AS customer_id,
    CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""

ORACLES = {
    "part_versions": f"""WITH {_CHANGES_SQL},
marked AS (SELECT *, CASE WHEN gone THEN 'gone' ELSE brand || '|' || size END AS says,
  lag(CASE WHEN gone THEN 'gone' ELSE brand || '|' || size END) OVER (PARTITION BY part_id ORDER BY since) AS before FROM changes),
kept AS (SELECT *, lead(since) OVER (PARTITION BY part_id ORDER BY since) AS next_at FROM marked
  WHERE says <> coalesce(before, 'gone')),
newest AS (SELECT part_id, arg_max(cents, since) AS cents FROM changes WHERE NOT gone GROUP BY part_id)
SELECT k.part_id, brand, size, n.cents, strftime(since, '%Y-%m-%d') AS valid_from, strftime(next_at, '%Y-%m-%d') AS valid_to
FROM kept k JOIN newest n ON k.part_id = n.part_id WHERE NOT gone""",
    "part_latest": f"""WITH {_CHANGES_SQL}
SELECT part_id, brand, size, cents, strftime(since, '%Y-%m-%d') AS changed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY since DESC, set_no DESC) AS r FROM changes) WHERE r = 1 AND NOT gone""",
    "customer_running_totals": f"""WITH {_ORDERS_SQL}
SELECT o_orderkey, customer_id, CAST(sum(cents) OVER w AS BIGINT) AS running_cents, row_number() OVER w AS n_orders,
  lag(cents) OVER w AS cents_before, strftime(lead(day) OVER w, '%Y-%m-%d') AS next_day
FROM orders2 WINDOW w AS (PARTITION BY customer_id ORDER BY day, o_orderkey)""",
    "ranked_export": """SELECT event_id, row_number() OVER (ORDER BY value DESC NULLS LAST, event_id) AS rank, value FROM events""",
    "rewritten_month": """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
last AS (SELECT max(month) AS month FROM o)
SELECT o.month, count(*) AS n_orders, CAST(sum(cents + CASE WHEN o.month = last.month THEN 100 ELSE 0 END) AS BIGINT) AS cents
FROM o, last WHERE o.month <> last.month OR o_orderkey % 10 <> 0 GROUP BY 1""",
    "quarantined_lines": """WITH marked AS (
  SELECT NOT (l_quantity BETWEEN 1 AND 45) AS quantity, NOT l_discount <= 0.08 AS discount,
    NOT l_shipdate >= TIMESTAMP '1993-01-01' AS ship_date, NOT l_extendedprice > 1000 AS price FROM lineitem),
counted AS (
  SELECT 'quantity' AS item, count(*) FILTER (quantity) AS n FROM marked
  UNION ALL SELECT 'discount', count(*) FILTER (discount) FROM marked
  UNION ALL SELECT 'ship_date', count(*) FILTER (ship_date) FROM marked
  UNION ALL SELECT 'price', count(*) FILTER (price) FROM marked
  UNION ALL SELECT 'valid_rows', count(*) FILTER (NOT (quantity OR discount OR ship_date OR price)) FROM marked)
SELECT item, n AS written, n AS observed FROM counted WHERE n > 0""",
    "compacted_orders": """SELECT o_orderstatus, count(*) AS n_orders,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(1 AS BIGINT) AS fewer_files FROM orders GROUP BY 1""",
    "colocated_orders": """SELECT o_orderstatus, count(*) AS n_lines,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "customers_by_month": """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS customers,
  CAST(1 AS BIGINT) AS close FROM orders GROUP BY 1""",
    "tree_difference": """WITH copy AS (
  SELECT CASE WHEN o_orderkey % 103 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, o_orderkey % 107 = 0 AS price,
    o_orderkey % 113 = 0 AND o_orderstatus <> 'X' AS status FROM orders WHERE o_orderkey % 101 <> 0)
SELECT o_orderkey, 'missing' AS verdict, '' AS columns FROM orders WHERE o_orderkey NOT IN (SELECT k FROM copy)
UNION ALL SELECT k, 'extra', '' FROM copy WHERE k < 0
UNION ALL SELECT k, 'duplicate', '' FROM copy WHERE k % 127 = 0 AND k >= 0
UNION ALL SELECT k, 'mismatch', CASE WHEN price AND status THEN 'o_totalprice,o_orderstatus' WHEN price THEN 'o_totalprice' ELSE 'o_orderstatus' END
FROM copy WHERE k >= 0 AND k % 127 <> 0 AND (price OR status)""",
    "stream_windowed_totals": f"""WITH
b AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 AS span FROM events),
placed AS (SELECT epoch_us(ts) AS us, event_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
  (epoch_us(ts) - lo) // span AS place FROM events, b),
arriving AS (SELECT *, CASE WHEN event_id % 7 = 0 AND place + {LATE_BY} < {SLICES} THEN place + {LATE_BY} ELSE place END AS batch FROM placed),
marks AS (SELECT batch, max(max(us)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 - {DELAY * 1000} AS mark
  FROM arriving GROUP BY batch),
final AS (SELECT max(us) // 1000 - {DELAY * 1000} AS mark FROM arriving),
kept AS (SELECT us // {WIDTH * 1_000_000} * {WIDTH * 1_000_000} AS start_us, event_type, cents
  FROM arriving a JOIN marks m ON a.batch = m.batch
  WHERE m.mark IS NULL OR (us // {WIDTH * 1_000_000} + 1) * {WIDTH * 1_000} > m.mark)
SELECT start_us, event_type, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents FROM kept, final
WHERE start_us // 1000 + {WIDTH * 1_000} <= final.mark GROUP BY 1, 2""",
    "stream_first_arrivals": "SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events",
}
