"""Integer-unit money against exact decimals."""

from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from conftest import collect
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkretail.functions import money

CENT = D("0.01")
price = st.decimals(D("-99999999.99"), D("99999999.99"), places=2)
big = st.decimals(D("-999999999999.99"), D("999999999999.99"), places=2)
pct = st.decimals(D("0"), D("1"), places=2)
fixed = st.decimals(D("0"), D("99.9999"), places=4)
FEW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def cents(x):
    return x.quantize(CENT, ROUND_HALF_UP)


@FEW
@given(rows=st.lists(st.tuples(st.integers(-500, 500), price, pct), min_size=50, max_size=200))
def test_revenue_and_contribution(spark, rows):
    df = spark.createDataFrame(rows, "q INT, p DECIMAL(10,2), d DECIMAL(5,2)")
    out = df.select(
        "q", "p", "d",
        money.line_revenue("q", "p", "d", 18).alias("r"),
        money.as_money(money.contribution_cents("q", "p", "d")).alias("c"),
    )
    for q, p, d, r, c in out.collect():
        assert r == cents(q * p * (1 - d))
        assert c == cents(q * p * (1 - d) ** 2)


@FEW
@given(rows=st.lists(st.tuples(big, st.integers(-50, 400), fixed), min_size=50, max_size=200))
def test_fee(spark, rows):
    df = spark.createDataFrame(rows, "a DECIMAL(14,2), b INT, f DECIMAL(6,4)")
    for a, b, f, fee in df.select("*", money.interchange_fee("a", "b", "f").alias("fee")).collect():
        assert fee == cents(a * b / 10000 + f)


def test_half_up_on_both_sides_of_zero(spark):
    df = spark.createDataFrame([(v,) for v in (49, 50, 51, 149, 150, -49, -50, -51, 0)], "v BIGINT")
    assert [r[0] for r in df.select(money.half_up(F.col("v"), 2)).collect()] == [0, 1, 1, 1, 2, 0, -1, -1, 0]


def test_units_are_exact_for_doubles_and_decimals(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7_919 % 10**9).alias("n"))
    as_double = df.select("n", money.units(F.col("n") / 100, 2).alias("u"))
    as_decimal = df.select("n", money.units((F.col("n").cast("decimal(14,0)") * D("0.01")).cast("decimal(14,2)"), 2).alias("u"))
    assert as_double.filter("n <> u").isEmpty()
    assert as_decimal.filter("n <> u").isEmpty()


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None, D("1.00"), D("0.00")), (1, None, D("0.00")), (1, D("1.00"), None)],
                               "q INT, p DECIMAL(10,2), d DECIMAL(5,2)")
    assert collect(df.select(money.line_revenue("q", "p", "d"))) == [(None,)] * 3


def test_wide_sum_passes_the_bigint_range(spark):
    huge = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(huge,), (huge,), (huge,), (-7,), (None,)], "v BIGINT")
    assert df.select(money.wide_sum(F.col("v"))).first()[0] == 3 * huge - 7
    assert df.select(money.money_sum(F.col("v"), 34)).first()[0] == D(3 * huge - 7) / 100
    assert df.filter("v < 0").groupBy().agg(money.wide_sum(F.col("v"))).first()[0] == -7


def test_overflow_is_an_error_or_null(spark):
    import pytest
    from pyspark.errors import ArithmeticException

    df = spark.createDataFrame([(1000, D("99999999.99"), D("0.00"))], "q INT, p DECIMAL(10,2), d DECIMAL(5,2)")
    assert df.select(money.line_revenue("q", "p", "d", 12, "null")).first()[0] is None
    with pytest.raises(ArithmeticException):
        df.select(money.line_revenue("q", "p", "d", 12)).collect()


def test_more_decimals_are_exact_or_an_error(spark):
    rows = [(3, D("10.0000"), D("0.1250")), (7, D("0.0050"), D("0.0000")), (1, D("1234567.8901"), D("0.3333")), (2, None, D("0.1"))]
    df = spark.createDataFrame(rows, "q INT, p DECIMAL(14,4), d DECIMAL(5,4)")
    out = df.select("q", "p", "d", money.line_revenue("q", "p", "d", 18).alias("r"),
                    money.as_money(money.contribution_cents("q", "p", "d")).alias("c"))
    for q, p, d, r, c in out.collect():
        assert (r, c) == ((None, None) if p is None else (cents(q * p * (1 - d)), cents(q * p * (1 - d) ** 2)))
    fee = spark.createDataFrame([(D("10.1234"), 125, D("0.0500"))], "a DECIMAL(14,4), r INT, f DECIMAL(6,4)")
    assert fee.select(money.interchange_fee("a", "r", "f")).first()[0] == cents(D("10.1234") * 125 / 10000 + D("0.05"))
    wide = spark.createDataFrame([(D("1234567890123456.78"),)], "a DECIMAL(18,2)")
    assert wide.select(money.units("a", 2)).first()[0] == 123456789012345678
    with pytest.raises(Exception, match="more than 2 decimals"):
        spark.createDataFrame([(0.125,)], "a DOUBLE").select(money.units("a", 2)).collect()
