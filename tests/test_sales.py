"""Worked examples of the retail operators."""

import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from conftest import collect
from pyspark.sql import functions as F

from sparkretail.functions import dates
from sparkretail.operators import aggregates, clean, compare, manifest, matching, ordering, windows
from sparkretail.sources.readers import plan_text
from sparkretail.synth import sales as synth


def df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


SALE = (
    "txn_id STRING, store_id INT, channel STRING, status STRING, payment_method STRING, "
    "customer_id INT, quantity INT, unit_price DECIMAL(10,2), discount_pct DECIMAL(5,2)"
)


def sale(id_, store, qty, price, disc="0.00", pay="card", cust=1, chan="POS", status="COMPLETED"):
    return (id_, store, chan, status, pay, cust, qty, D(price), D(disc))


def test_cleaning_example(spark):
    rows = df(
        spark,
        "txn_id STRING, product_id INT, quantity INT, discount_pct DECIMAL(5,2), currency STRING, status STRING",
        ("t1", 10, 2, D("0.10"), "USD", "COMPLETED"),
        ("t2", None, 2, D("0.10"), "USD", "COMPLETED"),
        ("t3", 10, 0, D("0.10"), "USD", "COMPLETED"),
        ("t4", 10, 100, None, "usd", "complete"),
        ("t5", 10, 101, D("0.10"), "USD", "COMPLETED"),
        ("t6", 10, 2, D("0.10"), "INR", "COMPLETED"),
        ("t7", 10, 2, D("0.10"), "USD", "CANCELLED"),
        ("t8", 10, None, D("0.10"), "USD", "COMPLETED"),
        ("t9", 10, 1, D("0.10"), None, "Complete"),
        ("u1", 10, 1, D("0.10"), "Usd", "COMPLETED"),
        ("u2", 10, 1, D("0.10"), "USD", None),
    )
    out = clean.clean(rows)
    assert manifest.schema_rows(out) == manifest.schema_rows(rows)
    assert collect(out) == [
        ("t1", 10, 2, D("0.10"), "USD", "COMPLETED"),
        ("t4", 10, 100, D("0.00"), "USD", "COMPLETED"),
        ("t9", 10, 1, D("0.10"), "USD", "COMPLETED"),
    ]


def test_mapping_equals_replace(spark):
    rows = df(spark, "c STRING", ("usd",), ("$",), ("USD",), (None,), (" usd",), ("",))
    mapping = clean.SALES_RULES.replacements["currency"]
    mapped = rows.select(clean.map_values("c", mapping).alias("c"))
    assert collect(mapped) == collect(rows.replace(mapping, subset=["c"]))


def test_ticket_collapse_example(spark):
    rows = df(
        spark, "txn_id STRING, channel STRING, quantity INT",
        ("t1", "POS", 2), ("t1", "POS", 2), ("  t2 ", "POS", 1), ("t3", "web", 4), ("t4", "app", 3),
    )
    assert collect(clean.collapse_tickets(rows)) == [("t1", "POS", 2), ("t2", "POS", 1)]
    copies = df(spark, "txn_id STRING, channel STRING, quantity INT", ("t1", "POS", 5), (" t1", "POS", 3))
    kept = clean.collapse_tickets_ordered(copies, [F.col("quantity")])
    assert collect(kept) == [("t1", "POS", 3)]


def test_store_list_example(spark):
    rows = df(
        spark, "store_id INT, channel STRING, status STRING",
        (3, "web", "COMPLETED"), (5, "POS", "COMPLETED"), (5, "POS", "COMPLETED"),
        (8, "POS", "CANCELLED"), (9, "POS", "COMPLETED"), (12, "POS", "COMPLETED"),
    )
    assert collect(ordering.store_list(rows, 2)) == [(5,), (9,)]
    assert collect(ordering.smallest_keys(rows, "store_id", 2)) == [(3,), (5,)]
    assert collect(compare.floor_versus_lake(rows, clean.floor(rows), "store_id")) == [(3,), (8,)]


def test_business_hours_example(spark):
    day = dt.datetime(2026, 1, 15)
    at = lambda h, m: day.replace(hour=h, minute=m)
    rows = df(
        spark,
        "store_id INT, event_ts TIMESTAMP_NTZ, quantity INT, unit_price DECIMAL(10,2), discount_pct DECIMAL(5,2)",
        (5, at(14, 0), 2, D("10.00"), D("0.00")), (5, at(16, 0), 1, D("10.00"), D("0.10")),
        (5, at(8, 59), 1, D("10.00"), D("0.00")), (5, at(21, 0), 1, D("50.00"), D("0.00")),
        (9, at(11, 0), 1, D("10.00"), D("0.00")), (9, at(22, 10), 3, D("10.00"), D("0.00")),
    )
    out = aggregates.store_contribution(rows)
    assert collect(out) == [(5, D("28.10"), 2), (9, D("10.00"), 1)]
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "decimal(12,2)", "bigint"]


def test_payment_profile_example(spark):
    rows = df(
        spark, SALE,
        sale("t1", 5, 2, "10.00"), sale("t2", 5, 1, "10.00", "0.10", "cash"), sale("t3", 5, 3, "10.00"),
        sale("t4", 9, 1, "50.00"), sale("t5", 9, 2, "10.00"),
        sale("t6", 9, 2, "10.00", chan="web"), sale("t7", 9, 2, "10.00", status="PENDING"),
    )
    out = aggregates.store_payment_profile(rows)
    assert collect(out) == [(5, ["card", "cash"], D("59.00"), 3, 2), (9, ["card"], D("70.00"), 2, 1)]
    assert [f.dataType.simpleString() for f in out.schema] == [
        "int", "array<string>", "decimal(12,2)", "bigint", "int",
    ]


def test_rollup_example_and_null_key(spark):
    rows = [
        sale("t1", 5, 2, "10.00"), sale("t2", 5, 1, "10.00", "0.10"),
        sale("t3", 5, 3, "10.00", pay="cash"), sale("t4", 9, 1, "50.00"),
    ]
    out = aggregates.store_rollup(df(spark, SALE, *rows))
    assert [tuple(r) for r in out.collect()] == [
        (5, "card", D("29.00"), 2), (5, "cash", D("30.00"), 1), (5, None, D("59.00"), 3),
        (9, "card", D("50.00"), 1), (9, None, D("50.00"), 1), (None, None, D("109.00"), 4),
    ]
    with_null = df(spark, SALE, *rows, sale("t5", 9, 1, "1.00", pay=None))
    levels = aggregates.store_rollup(with_null, with_level=True).filter("store_id = 9 AND payment_method IS NULL")
    assert sorted((r.level, r.total_revenue) for r in levels.collect()) == [(0, D("1.00")), (1, D("51.00"))]
    profile = aggregates.store_payment_profile(with_null).filter("store_id = 9").first()
    assert (profile.payment_methods, profile.ticket_count, profile.payment_variety) == (["card"], 2, 1)


def test_segments_take_elements_of_the_data(spark):
    rows = df(
        spark, SALE,
        sale("t1", 5, 2, "10.00", cust=101), sale("t2", 5, 1, "50.00", "0.10", cust=101, chan="ONLINE"),
        sale("t3", 5, 1, "10.00", cust=102), sale("t4", 5, 3, "30.00", cust=103, chan="ONLINE"),
        sale("t5", 9, 1, "100.00", cust=201), sale("t6", 9, 2, "10.00", cust=201, chan="ONLINE"),
    )
    assert collect(aggregates.store_segments(rows)) == [
        (5, 3, D("10.00"), D("20.00"), D("45.00"), 4),
        (9, 1, D("20.00"), D("20.00"), D("100.00"), 2),
    ]


def test_audit_seed_example(spark):
    rows = df(
        spark, "txn_id STRING, channel STRING, status STRING, product_id INT",
        ("AUDIT-A", "AUDIT", "COMPLETED", 17), ("AUDIT-B", "AUDIT", "COMPLETED", 42),
        ("t1", "POS", "COMPLETED", 200), ("t2", "POS", "CANCELLED", 201), ("t3", "web", "COMPLETED", 202),
    )
    assert ordering.audit_seed(rows) == 42
    assert collect(clean.floor(rows).select("txn_id")) == [("t1",)]
    with pytest.raises(ValueError):
        ordering.audit_seed(rows.filter("product_id > 100"))


def test_hash_sample_ignores_layout(spark):
    rows = spark.range(20_000).withColumn("k", F.concat(F.lit("k"), F.col("id")))
    a = ordering.hash_sample(rows.repartition(7), "k", 0.1, seed=3)
    b = ordering.hash_sample(rows.coalesce(1), "k", 0.1, seed=3)
    assert compare.same_rows(a, b)
    assert 1_800 < a.count() < 2_200
    assert ordering.hash_sample(rows, "k", 0.0).count() == 0
    assert ordering.hash_sample(rows, "k", 1.0).count() == 20_000


def test_orphans_and_matched(spark):
    sales = df(spark, "txn_id INT, product_id INT", (1, 1), (2, 999), (3, None), (4, 1))
    products = df(spark, "product_id INT, product_name STRING", (1, "Widget A"), (1, "again"))
    for max_bytes in (10**9, 0):
        assert collect(matching.orphans(sales, products, ["product_id"], max_bytes).select("txn_id")) == [(2,), (3,)]
        assert collect(matching.matched(sales, products, ["product_id"], max_bytes).select("txn_id")) == [(1,), (4,)]


def test_latest_version_with_ties(spark):
    rows = df(
        spark, "product_id INT, product_name STRING, category STRING, brand STRING, list_price DECIMAL(10,2), effective_ts DATE",
        (1, "b", "c", "x", D("2.00"), dt.date(2024, 1, 8)), (1, "a", "c", "x", D("1.00"), dt.date(2024, 1, 8)),
        (1, "0", "c", "x", D("1.00"), dt.date(2024, 1, 1)), (2, "z", "c", "x", D("9.00"), dt.date(2020, 1, 1)),
    )
    assert [r[:2] for r in collect(windows.current_catalog(rows))] == [(1, "a"), (2, "z")]


def test_latest_version_is_limited_before_the_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan_text(windows.latest_per_key(orders, ["o_custkey"], [F.col("o_orderkey").desc()]), "simple")
    partial = text.rindex("WindowGroupLimit")
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < partial


def test_cleaning_and_revenue_do_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "sales")
    synth.sales(synth.key_range(spark, 1_000)).write.parquet(path)
    sales = spark.read.parquet(path)
    for df_ in (clean.clean(sales), clean.valid_line_revenue(sales), clean.add_line_revenue(sales)):
        assert "Exchange" not in plan_text(df_)
    text = plan_text(aggregates.store_rollup(sales))
    assert "EqualTo(channel,POS)" in text and "EqualTo(status,COMPLETED)" in text
    scan = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "customer_id" not in scan and "event_ts" not in scan


def test_schedule_periods(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2023-12-25', DATE '2024-01-22')) AS d")
    epoch = dt.date(2024, 1, 1)
    for d, n, start in days.select("d", dates.period_index(F.col("d"), epoch, 7), dates.period_start(F.col("d"), epoch, 7)).collect():
        assert n == (d - epoch).days // 7 and start == epoch + dt.timedelta(days=7 * n)


def test_overlapping_versions(spark):
    d = lambda n: dt.date(2024, 1, n)
    schema = "k STRING, effective_from DATE, effective_to DATE"
    fine = df(spark, schema, ("a", d(1), d(7)), ("a", d(8), d(14)), ("b", d(1), d(31)))
    assert windows.overlapping_versions(fine, ["k"]).isEmpty()
    # The second version is short; the third overlaps the first, not the second.
    bad = df(spark, schema, ("a", d(1), d(20)), ("a", d(2), d(3)), ("a", d(10), d(12)))
    assert windows.overlapping_versions(bad, ["k"]).count() == 2


def test_split_keeps_rows_with_null_keys(spark):
    rows = df(spark, "k STRING", ("a",), ("b",), (None,))
    hot, cold = clean.split_on(rows, F.col("k") == "a")
    assert collect(hot) == [("a",)] and collect(cold) == [("b",), (None,)]


def test_customer_totals_match_plain_grouping(spark):
    tx = spark.range(50_000).select(
        F.col("id").cast("string").alias("txn_id"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 99).alias("customer_id"),
        (F.col("id") * 37 % 10_007 - 50).alias("cents"),
    )
    got = aggregates.customer_totals(tx, "customer_id", F.col("cents"))
    want = tx.groupBy("customer_id").agg(
        F.count("*"), (F.sum("cents") / 100).cast("decimal(18,2)"), (F.min("cents") / 100).cast("decimal(18,2)"),
        (F.max("cents") / 100).cast("decimal(18,2)"),
        (F.round(F.sum("cents").cast("decimal(20,0)") / F.count("*").cast("decimal(10,0)")) * F.lit(D("0.01"))).cast("decimal(18,2)"),
    )
    assert collect(got) == collect(want)


def test_customer_mean_rounds_half_away_from_zero(spark):
    tx = df(spark, "txn_id STRING, c STRING, cents BIGINT", ("1", "a", 1), ("2", "a", 2), ("3", "b", -1), ("4", "b", -2), ("5", "z", 0))
    got = aggregates.customer_totals(tx, "c", F.col("cents")).select("c", "avg_amount")
    assert collect(got) == [("a", D("0.02")), ("b", D("-0.02")), ("z", D("0.00"))]


def test_run_statistics_skip_failed_and_missing(spark):
    runs = df(
        spark, "variant STRING, terminal_state STRING, wall DOUBLE, skew DOUBLE",
        ("broken", "COMPLETED", 10.0, 8.0), ("broken", "COMPLETED", 20.0, None),
        ("broken", "FAILED", 99.0, 99.0), ("fixed", "COMPLETED", 5.0, 1.5),
    )
    out = aggregates.run_statistics(runs, "variant", ["wall", "skew"])
    assert collect(out) == [
        ("broken", 2, 15.0, 10.0, 20.0, 8.0, 8.0, 8.0), ("fixed", 1, 5.0, 5.0, 5.0, 1.5, 1.5, 1.5),
    ]


def test_generated_sales_are_clean_and_layout_independent(spark):
    a = synth.sales(synth.key_range(spark, 5_000).repartition(7))
    b = synth.sales(synth.key_range(spark, 5_000).coalesce(1))
    assert compare.same_rows(a, b)
    assert a.columns == [
        "txn_id", "store_id", "register_id", "product_id", "product_code", "customer_id", "quantity",
        "unit_price", "discount_pct", "currency", "status", "channel", "payment_method", "country_code", "event_ts",
    ]
    assert a.select("txn_id").distinct().count() == 5_000
    assert clean.clean(a).count() == 5_000
    assert aggregates.business_hours(a).count() == 5_000
    low, high, price_low, price_high = a.agg(
        F.min("quantity"), F.max("quantity"), F.min("unit_price"), F.max("unit_price")
    ).first()
    assert (low, high) == (1, 99) and D("1.00") <= price_low < price_high <= D("99.99")


def test_dirt_is_one_defect_per_row_and_cleaning_sorts_it_out(spark):
    rows = synth.sales(synth.key_range(spark, 20_000)).withColumn("key", F.xxhash64("txn_id").bitwiseAND(F.lit(2**40 - 1)))
    dirty = synth.plant_dirt(rows, "key", 0.12, keep_kind=True)
    kinds = {r.kind: r["count"] for r in dirty.groupBy("kind").count().collect()}
    assert set(kinds) == {None, *synth.DIRT_KINDS}
    assert 0.10 < 1 - kinds[None] / 20_000 < 0.14
    kept = Counter(r.kind for r in clean.clean(dirty).select("kind").collect())
    repaired = {"qty_100", "null_discount", "currency_usd_alias", "currency_dollar", "currency_null",
                "status_complete_alias", "status_Complete"}
    assert set(kept) == {None, *repaired}
    assert all(kept[k] == kinds[k] for k in kept)


def test_ticket_edges(spark):
    rows = synth.sales(synth.key_range(spark, 5_000)).withColumns(
        {"key": F.xxhash64("txn_id").bitwiseAND(F.lit(2**40 - 1)), "channel": F.lit("POS")}
    )
    edged = synth.plant_ticket_edges(rows, "key", 0.3)
    assert edged.count() > 5_000
    assert edged.filter(F.col("txn_id") != F.trim("txn_id")).count() > 0
    collapsed = clean.collapse_tickets(edged)
    in_store = edged.filter("channel = 'POS'").select(F.trim("txn_id")).distinct().count()
    assert collapsed.count() == in_store < 5_000


def test_manifest(spark):
    rows = df(spark, "k INT, v STRING", (1, "a"), (1, None), (2, "b"), (None, "b"))
    out = manifest.manifest(rows, {"ones": F.col("k") == 1}, ["k", "v"])
    assert dict(collect(out)) == {
        "rows": 4, "ones": 2, "null_k": 1, "null_v": 1, "distinct_k": 2, "distinct_v": 2,
    }
    assert manifest.schema_rows(rows) == [("k", "int"), ("v", "string")]
