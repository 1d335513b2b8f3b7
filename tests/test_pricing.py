"""Pricing strategies, settlement rollups, and the plans behind them."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import collect
from pyspark.sql import functions as F

from sparkretail.operators import compare, pricing, settlement, skew, windows
from sparkretail.plans import payment_queries
from sparkretail.session import PROFILES, conf_overlay, profiled
from sparkretail.sources.readers import plan_text
from sparkretail.synth import payments as pay
from sparkretail.synth import reference_data as ref
from sparkretail.synth.sales import key_range

N = 6_000


@pytest.fixture(scope="module")
def fact(spark):
    made = pay.payments(key_range(spark, N), hot_share=0.75)
    return pricing.approved(made).persist()


@pytest.fixture(scope="module")
def rates(spark):
    return pay.rate_card(spark).persist()


@pytest.fixture(scope="module")
def expected(fact, rates):
    """The question stated once more, in decimals and without any of the library's plans."""
    f, r = fact.alias("f"), rates.alias("r")
    joined = f.join(
        r,
        (F.col("f.mcc") == F.col("r.mcc"))
        & (F.col("f.country_code") == F.col("r.country_code"))
        & (F.col("f.entry_mode") == F.col("r.entry_mode"))
        & F.to_date("f.txn_ts").between(F.col("r.effective_from"), F.col("r.effective_to")),
    )
    fee = F.round(F.col("amount") * F.col("rate_bps") / F.lit(10000) + F.col("fixed_fee"), 2)
    return joined.select(
        "f.txn_id", "f.txn_ts", "f.mcc", "f.country_code", "f.entry_mode", "f.amount", "r.rate_id",
        fee.cast("decimal(18,2)").alias("interchange_fee"),
    ).persist()


@pytest.mark.parametrize("strategy", pricing.STRATEGIES)
@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, 0])
def test_every_strategy_prices_the_same(fact, rates, expected, strategy, limit):
    priced = pricing.price(fact, rates, strategy, window=pay.FACT_WINDOW, max_bytes=limit)
    assert compare.same_rows(expected, pricing.priced_rows(priced))


def test_every_approved_row_has_one_rate(fact, expected):
    assert expected.count() == fact.count()


def test_window_is_found_when_not_given(fact, rates, expected):
    assert pricing.fact_window(fact) <= pay.FACT_WINDOW
    for strategy in ("auto", "period_key", "broadcast"):
        priced = pricing.price(fact, rates, strategy)
        assert compare.same_rows(expected, pricing.priced_rows(priced))


def test_period_key_with_long_and_unaligned_versions(spark):
    d = dt.date
    fact = spark.createDataFrame(
        [(f"t{n}", dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=23), "1", "US", "chip", D("10.00")) for n in range(40)]
        + [("null", dt.datetime(2024, 1, 5), None, "US", "chip", D("10.00"))],
        "txn_id STRING, txn_ts TIMESTAMP_NTZ, mcc STRING, country_code STRING, entry_mode STRING, amount DECIMAL(14,2)",
    )
    rates = spark.createDataFrame(
        [("a", "1", "US", "chip", d(2023, 6, 1), d(2024, 1, 3), 100, D("0.0050")),
         ("b", "1", "US", "chip", d(2024, 1, 4), d(2024, 1, 24), 200, D("0.0050")),
         ("c", "1", "US", "chip", d(2024, 1, 26), d(2099, 12, 31), 300, D("0.0050"))],
        "rate_id STRING, mcc STRING, country_code STRING, entry_mode STRING, effective_from DATE, "
        "effective_to DATE, rate_bps INT, fixed_fee DECIMAL(6,4)",
    )
    window = (d(2024, 1, 1), d(2024, 2, 9))
    want = collect(pricing.price(fact, rates, "naive").select("txn_id", "rate_id"))
    # Every day but the 25th of January is covered.
    assert len(want) == 39
    for strategy in pricing.STRATEGIES:
        priced = pricing.price(fact, rates, strategy, window=window)
        assert collect(priced.select("txn_id", "rate_id")) == want, strategy


def test_settlement_reports_match_plain_aggregates(fact, rates, expected):
    priced = pricing.price(fact, rates, window=pay.FACT_WINDOW)
    by_entry = expected.groupBy("country_code", "entry_mode").agg(
        F.count("*"), F.sum("interchange_fee"), F.countDistinct("rate_id")
    )
    assert collect(settlement.settle_by_entry(priced)) == collect(by_entry)
    by_month = expected.groupBy("country_code", F.date_format("txn_ts", "yyyy-MM").alias("m")).agg(
        F.sum("amount"), F.sum("interchange_fee"),
        F.count(F.when(F.col("interchange_fee") > F.lit(D("0.25")), 1)),
    )
    assert collect(settlement.settle_by_month(priced)) == collect(by_month)


def test_sum_of_rounded_fees_is_not_the_rounded_sum(fact, rates, expected):
    total = settlement.row_totals(pricing.price(fact, rates, window=pay.FACT_WINDOW)).first()
    unrounded = fact.join(rates, pricing.KEYS).filter(
        F.to_date("txn_ts").between(F.col("effective_from"), F.col("effective_to"))
    ).agg(F.round(F.sum(F.col("amount") * F.col("rate_bps") / 10000 + F.col("fixed_fee")), 2)).first()[0]
    assert total.fee_total == expected.agg(F.sum("interchange_fee")).first()[0]
    assert total.fee_total != unrounded


def test_plans_agree_notices_a_wrong_plan(fact, rates):
    good = settlement.settle_by_month(pricing.price(fact, rates, "auto", window=pay.FACT_WINDOW))
    other = settlement.settle_by_month(pricing.price(fact, rates, "salted", window=pay.FACT_WINDOW))
    assert settlement.plans_agree(settlement.strategy_totals({"auto": good, "salted": other}))
    wrong = good.withColumn("review_txns", F.col("review_txns") + 1)
    assert not settlement.plans_agree(settlement.strategy_totals({"auto": good, "wrong": wrong}))


def test_broadcast_plan_does_not_shuffle_the_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    pay.payments(key_range(spark, 2_000), hot_share=0.75).write.parquet(path)
    fact = pricing.approved(spark.read.parquet(path))
    rates = pay.rate_card(spark)
    text = plan_text(pricing.price(fact, rates, "auto", window=pay.FACT_WINDOW))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text
    # The scan reads only what pricing needs, and the approval filter reaches it.
    scan = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "card_number" not in scan and "merchant_id" not in scan
    assert "EqualTo(response_code,00)" in text
    for strategy in ("naive", "pruned", "salted", "period_key"):
        assert "SortMergeJoin" in plan_text(pricing.price(fact, rates, strategy, window=pay.FACT_WINDOW))


def test_aqe_profile_runs(spark, fact, rates, expected):
    with conf_overlay(spark, PROFILES["skew_aqe"]):
        priced = pricing.price(fact, rates, "aqe", window=pay.FACT_WINDOW)
        assert compare.same_rows(expected, pricing.priced_rows(priced))


def test_aqe_splits_the_hot_partition(spark, fact, rates, expected):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.shuffle.partitions": "64",
    }
    with conf_overlay(spark, {**PROFILES["skew_aqe"], **small}):
        rows = pricing.priced_rows(pricing.price(fact.repartition(8), rates, "aqe", window=pay.FACT_WINDOW))
        got = collect(rows)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    assert got == collect(expected)
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan


def test_adaptive_report_leaves_the_session_alone(spark, sf):
    keys = list(PROFILES["skew_aqe"])
    before = [spark.conf.get(k, None) for k in keys]
    adaptive = payment_queries.month_rollup("aqe", spark, sf)
    assert [spark.conf.get(k, None) for k in keys] == before
    own = profiled(spark, "skew_aqe")
    plan = plan_text(settlement.settle_by_month(payment_queries.priced(own, sf, "aqe")))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert compare.same_rows(payment_queries.month_rollup("auto", spark, sf), adaptive)


def test_salt_is_a_function_of_the_row(spark):
    ids = spark.range(10_000).select(F.col("id").cast("string").alias("txn_id"))
    a = ids.withColumn("s", skew.salt_of("txn_id", 16))
    b = ids.repartition(5).withColumn("s", skew.salt_of("txn_id", 16))
    assert compare.same_rows(a, b)
    sizes = [r["count"] for r in a.groupBy("s").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).unionByName(
        spark.createDataFrame([(7, -1), (None, -2)], "k BIGINT, w BIGINT")
    )
    got, want = skew.salted_join(left, right, ["k"], how, rows_per_task=300), left.join(right, ["k"], how)
    assert got.columns == want.columns
    assert compare.same_rows(want, got)
    assert collect(skew.hot_keys(left.dropna(), ["k"], 300)) == [(7, 4)]
    equal = spark.range(15_000).select((F.col("id") % 150).alias("k"))
    assert skew.hot_keys(equal, ["k"], 30).filter("parts = 4").count() == 150


def test_salted_join_copies_hot_keys_only(spark):
    left = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    plan = skew.salted_join(left, spark.range(5_000).withColumnRenamed("id", "k"), ["k"], "left_semi", rows_per_task=1_000)
    assert plan.count() == left.filter("k < 5000").count()


def test_rate_card(spark, rates):
    assert rates.count() == 130 * 30 * 25 * 7
    assert [(f.name, f.dataType.simpleString()) for f in rates.schema] == [
        ("rate_id", "string"), ("mcc", "string"), ("country_code", "string"), ("entry_mode", "string"),
        ("effective_from", "date"), ("effective_to", "date"), ("rate_bps", "int"),
        ("fixed_fee", "decimal(6,4)"), ("program_code", "string"), ("program_name", "string"),
    ]
    assert windows.overlapping_versions(rates, pricing.KEYS).isEmpty()
    first = rates.filter("rate_id = 'IC000000001'").first()
    assert (first.mcc, first.country_code, first.entry_mode) == ("5411", "US", "chip")
    assert (first.rate_bps, first.fixed_fee) == (128, D("0.0060"))
    assert first.program_code == "RETA-CHIP-W00"
    last = rates.agg(F.max("effective_to"), F.max("effective_from")).first()
    assert last == (dt.date(2099, 12, 31), dt.date(2024, 1, 1) + dt.timedelta(days=7 * 129))
    assert rates.select("rate_id").distinct().count() == 682_500


def test_settlement_groups_use_every_schedule_of_the_half_year(spark, rates):
    """One payment per key and day: 175 groups, 30 categories x 26 weeks each."""
    days = F.explode(F.sequence(F.lit(0), F.lit(181)))
    keys = rates.select(*pricing.KEYS).distinct().withColumn("d", days)
    fact = keys.select(
        F.concat_ws("-", *pricing.KEYS, "d").alias("txn_id"),
        F.timestamp_add("DAY", F.col("d"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("txn_ts"),
        *pricing.KEYS, F.lit(D("10.00")).cast("decimal(14,2)").alias("amount"),
    )
    window = (dt.date(2024, 1, 1), dt.date(2024, 6, 30))
    out = settlement.settle_by_entry(pricing.price(fact, rates, "auto", window=window))
    stats = out.agg(
        F.count("*"), F.min("distinct_rate_versions_used"), F.max("distinct_rate_versions_used"), F.sum("txn_count")
    ).first()
    assert stats == (175, 780, 780, 175 * 30 * 182)


def test_payments_generator(spark):
    wide = pay.payments(key_range(spark, 40_000), hot_share=0.75).persist()
    hot = wide.filter(pricing.is_key(ref.HOT_KEY)).count() / 40_000
    approved = wide.filter("response_code = '00'")
    assert abs(hot - 0.75) < 0.01
    assert abs(approved.count() / 40_000 - 0.88) < 0.01
    assert wide.filter("settled AND response_code <> '00'").isEmpty()
    assert abs(approved.filter("settled").count() / approved.count() - 0.94) < 0.01
    assert wide.filter("(auth_code = '') <> (response_code <> '00')").isEmpty()
    abroad = wide.filter("merchant_country <> country_code").count() / 40_000
    assert 0.08 < abroad < 0.13
    assert wide.agg(F.min("amount"), F.max("amount")).first()[0] >= D("0.01")
    plain = pay.payments(key_range(spark, 5_000), hot_mcc_share=0.9, wide=False)
    assert abs(plain.filter("mcc = '5411'").count() / 5_000 - 0.9) < 0.02
    assert "card_token" in plain.columns and "settled" not in plain.columns
    with pytest.raises(ValueError):
        pay.hot_key_probability(0.001)


def test_directories(spark):
    sizes = {name: df.count() for name, df in pay.directories(spark).items()}
    assert sizes == {"country": 25, "mcc": 30, "currency": 20, "response_code": 12, "entry_mode": 7, "acquirer": 15}
    assert dict(pay.directories(spark)["currency"].dtypes)["minor_units"] == "tinyint"
