"""Clickstream queries over ``events``, ``part`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.dates import epoch_micros
from sparkretail.functions.draws import pick, with_draws
from sparkretail.operators import matching
from sparkretail.plans import derive
from sparkretail.plans.derive import CLICKS_SQL, LINES_SQL, sql_draws, sql_padded, sql_pick, table
from sparkretail.session import fresh_path, profiled
from sparkretail.sources import readers, schemas
from sparkretail.streaming import attribution
from sparkretail.synth import clicks as synth
from sparkretail.synth import reference_data as ref

WITHIN = 3600
SLICES = 6
LATE_BY = 3
VERSIONS, TIE_RATE, SEED = 4, 0.01, 42
CLICK_STREAMS = {"u_type": 24, "u_orphan": 25}


def interval_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase of a visitor within an hour after one of their views or clicks."""
    return matching.interval_pairs(
        derive.impressions(spark, sf),
        derive.purchases(spark, sf),
        "visitor_id",
        "impression_ts",
        "purchase_ts",
        WITHIN,
        [F.col(c) for c in attribution.OUTPUT],
    )


def _bounds(spark: SparkSession, sf: str) -> tuple[int, int]:
    """First and last event time in microseconds, one row to the driver."""
    ts = epoch_micros(F.col("ts"))
    low, high = table(spark, sf, "events").agg(F.min(ts), F.max(ts)).first()
    return low, high


def _slice(ts: str, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    width = (high - low) // SLICES + 1
    return F.floor((epoch_micros(F.col(ts)) - low) / width).cast("int")


def _stream(spark: SparkSession, sf: str, late: bool) -> DataFrame:
    """Write both sides as event-time slices, stream them, and read the pairs back.

    With ``late``, every seventh purchase arrives three slices after its event time,
    which is behind the watermark by then.
    """
    bounds = _bounds(spark, sf)
    base = fresh_path(spark, "attribution")
    impressions = derive.impressions(spark, sf).withColumn("slice", _slice("impression_ts", bounds))
    arrival = _slice("purchase_ts", bounds)
    if late:
        is_late = (F.col("purchase_id").cast("bigint") % 7 == 0) & (arrival + LATE_BY < SLICES)
        arrival = F.when(is_late, arrival + LATE_BY).otherwise(arrival)
    purchases = derive.purchases(spark, sf).withColumn("slice", arrival)

    attribution.write_slices(impressions, "slice", SLICES, f"{base}/impressions")
    attribution.write_slices(purchases, "slice", SLICES, f"{base}/purchases")
    own = profiled(spark, "streaming")
    pairs = attribution.attribute(
        readers.stream_files(own, f"{base}/impressions", schemas.IMPRESSIONS),
        readers.stream_files(own, f"{base}/purchases", schemas.PURCHASES),
        window_seconds=WITHIN,
    )
    attribution.drain_to_files(
        pairs, f"{base}/pairs", f"{base}/checkpoint", spark.sparkContext.defaultParallelism
    )
    return spark.read.schema(pairs.schema).parquet(f"{base}/pairs")


def stream_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs from a stream in event-time order: nothing is late."""
    return _stream(spark, sf, late=False)


def stream_late_drop(spark: SparkSession, sf: str) -> DataFrame:
    """A stream with late purchases loses exactly their pairs."""
    return _stream(spark, sf, late=True)


def stream_batch_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Batch pairs minus the pairs of the late stream."""
    return attribution.stream_batch_difference(
        interval_pairs(spark, sf), stream_late_drop(spark, sf)
    ).select("impression_id", "purchase_id", "surplus")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"))
    return synth.catalog(parts, VERSIONS, TIE_RATE, seed=SEED)


def catalog_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog(spark, sf).groupBy("effective_ts", "brand").agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.sum("list_price").cast("decimal(24,2)").alias("list_price"),
        F.count_if(F.col("product_name").endswith("-alt")).alias("ties"),
    )


def enriched_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as product events joined to the current catalog; 4 % ask for products
    that do not exist."""
    drawn = with_draws(derive.lines(spark, sf), "key", CLICK_STREAMS)
    events = drawn.select(
        F.col("key").alias("event_id"),
        F.when(F.col("u_orphan") % 100 < 4, F.lit(-1).cast("bigint"))
        .otherwise(F.col("l_partkey"))
        .alias("product_id"),
        pick(F.col("u_type"), ref.CLICK_TYPES).alias("event_type"),
        F.col("l_extendedprice").alias("amount"),
    )
    return matching.enrich_current(events, _catalog(spark, sf))


def synthetic_clicks(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "events").select(F.col("event_id").alias("key"))
    made = synth.click_events(keys, n_products=2_000, orphan_rate=0.03, seed=SEED)
    return made.groupBy("event_type", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("product_id") > 2_000).alias("orphans"),
        F.sum("quantity").alias("quantity"),
        F.sum("amount").cast("decimal(24,2)").alias("amount"),
        F.max("visitor_id").alias("last_visitor"),
    )


def wide_events(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "events").select(F.col("event_id").alias("key"))
    made = synth.wide_events(keys, payload_chars=256, seed=SEED)
    return made.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("amount").cast("decimal(24,2)").alias("amount"),
        F.sum(F.length("payload")).alias("payload_chars"),
        F.sum(F.dayofmonth("event_ts")).alias("days"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        interval_pairs, stream_pairs, stream_late_drop, stream_batch_difference,
        catalog_versions, enriched_clicks, synthetic_clicks, wide_events,
    )
}

PAIRS_SQL = f"""{CLICKS_SQL},
b AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 AS width FROM events),
pairs AS (SELECT i.impression_id, p.purchase_id, i.visitor_id, i.campaign_id, p.product_id,
  CAST(p.amount AS DOUBLE) AS amount,
  p.event_id % 7 = 0 AND (epoch_us(p.purchase_ts) - b.lo) // b.width + {LATE_BY} < {SLICES} AS late
  FROM impressions i JOIN purchases p ON i.visitor_id = p.visitor_id
   AND p.purchase_ts >= i.impression_ts AND p.purchase_ts <= i.impression_ts + INTERVAL {WITHIN} SECONDS, b)"""

_CATALOG_SQL = f"""parts AS (SELECT p_partkey AS pid FROM part),
{sql_draws("parts", "tied", "pid", {"u_tie": SEED * 100 + 70})},
listed AS (SELECT pid, unnest(range({VERSIONS})) AS n, false AS tie FROM tied
  UNION ALL SELECT pid, {VERSIONS - 1}, true FROM tied WHERE u_tie % 10000 < {int(TIE_RATE * 10000)}),
{sql_draws("listed", "versions", f"pid * {VERSIONS} + n", {"u_category": SEED * 100 + 71})},
catalog AS (SELECT pid AS product_id,
  'sku-' || {sql_padded("pid", 8)} || CASE WHEN tie THEN '-alt' ELSE '-v' || {sql_padded("n", 3)} END AS product_name,
  CASE WHEN tie THEN 'Kitchen' WHEN n = {VERSIONS - 1} THEN {sql_pick("pid", ref.CATEGORIES)}
    ELSE {sql_pick("u_category", ref.CATEGORIES)} END AS category,
  {sql_pick("pid", ref.BRANDS)} AS brand, CAST(pid % 4000 + 1000 + n * 25 AS DECIMAL(12,2)) * 0.01 AS list_price,
  strftime(DATE '2020-01-01' + CAST(n * 7 AS INT), '%Y-%m-%d') AS effective_ts, tie FROM versions)"""

_PAIR_COLUMNS = "impression_id, purchase_id, visitor_id, campaign_id, product_id, amount"
_CLICK_DRAWS = {f"u_{s}": SEED * 100 + 80 + i for i, s in enumerate(
    ("pid", "orphan", "type", "cents", "qty", "visitor", "chan", "ctry")
)}
_WIDE_DRAWS = {"u_s": SEED * 100 + 90, "u_cents": SEED * 100 + 92, "u_region": SEED * 100 + 93}

ORACLES = {
    "interval_pairs": f"WITH {PAIRS_SQL} SELECT {_PAIR_COLUMNS} FROM pairs",
    "stream_pairs": f"WITH {PAIRS_SQL} SELECT {_PAIR_COLUMNS} FROM pairs",
    "stream_late_drop": f"WITH {PAIRS_SQL} SELECT {_PAIR_COLUMNS} FROM pairs WHERE NOT late",
    "stream_batch_difference": f"WITH {PAIRS_SQL} SELECT impression_id, purchase_id, CAST(1 AS BIGINT) AS surplus FROM pairs WHERE late",
    "catalog_versions": f"""WITH {_CATALOG_SQL} SELECT effective_ts, brand, count(*) AS n_versions,
  CAST(sum(list_price) AS DOUBLE) AS list_price, count(*) FILTER (tie) AS ties FROM catalog GROUP BY 1, 2""",
    "enriched_clicks": f"""WITH {_CATALOG_SQL}, {LINES_SQL},
{sql_draws("lines", "d", "key", CLICK_STREAMS)},
current_version AS (SELECT * FROM catalog
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY effective_ts DESC, product_name) = 1)
SELECT d.key AS event_id, c.product_id, {sql_pick("u_type", ref.CLICK_TYPES)} AS event_type, l_extendedprice AS amount,
  c.product_name, c.category, c.brand, CAST(c.list_price AS DOUBLE) AS list_price, c.effective_ts
FROM d JOIN current_version c ON c.product_id = d.l_partkey WHERE NOT u_orphan % 100 < 4""",
    "synthetic_clicks": f"""WITH {sql_draws("events", "d", "event_id", _CLICK_DRAWS)},
made AS (SELECT {sql_pick("u_type", ref.CLICK_TYPES)} AS event_type, {sql_pick("u_chan", ref.CLICK_CHANNELS)} AS channel,
  u_orphan % 10000 < 300 AS orphan, CAST(u_cents % 9900 + 100 AS DECIMAL(18,2)) * 0.01 AS amount,
  u_qty % 5 + 1 AS qty, 'vis-' || {sql_padded("u_visitor % 50000 + 1", 6)} AS visitor_id FROM d)
SELECT event_type, channel, count(*) AS n_rows, count(*) FILTER (orphan) AS orphans,
  CAST(sum(CASE WHEN event_type IN ('purchase', 'refund') THEN qty ELSE 0 END) AS BIGINT) AS quantity,
  CAST(sum(amount) AS DOUBLE) AS amount, max(visitor_id) AS last_visitor FROM made GROUP BY 1, 2""",
    "wide_events": f"""WITH {sql_draws("events", "d", "event_id", _WIDE_DRAWS)}
SELECT {sql_pick("u_region", ref.REGIONS)} AS region, count(*) AS n_rows,
  CAST(sum(CAST(u_cents % 4999999 + 1 AS DECIMAL(18,2)) * 0.01) AS DOUBLE) AS amount,
  CAST(256 * count(*) AS BIGINT) AS payload_chars,
  CAST(sum(1 + (u_s % {30 * 86400}) // 86400) AS BIGINT) AS days FROM d GROUP BY 1""",
}
