"""Exact money arithmetic on integer units.

Every line is rounded half-up to cents *before* it is summed, because
``SUM(ROUND(x, 2))`` is not ``ROUND(SUM(x), 2)``. Spark multiplies and divides wide
decimals through BigDecimal objects, one per row and operator; the same formulas on
``bigint`` units (cents, basis points, ten-thousandths) give identical digits inside
whole-stage codegen. Decimals appear again only where a result is emitted.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base that splits one wide sum into two bigint sums, see wide_sum().
_SUM_BASE = 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: int) -> Column:
    """Integer division that truncates towards zero, as SQL ``a DIV b``."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _scaled(c: Column, scale: int) -> Column:
    return c.cast("double") * F.lit(float(10**scale))


def is_exact(c: Column | str, scale: int) -> Column:
    """True if an amount has no more than ``scale`` decimals. A double counts as the
    decimal it stands for: its distance is measured against double precision."""
    x = _scaled(_col(c), scale)
    return F.abs(x - F.rint(x)) <= F.lit(1e-6) + F.abs(x) * 4e-16


def units(c: Column | str, scale: int) -> Column:
    """A decimal or double amount as a whole number of ``10**-scale`` units.

    Never rounds: an amount with more decimals raises an error. Below 10^15 units the
    nearest double times the power of ten lies within half a unit of the true integer;
    beyond, the amount goes through decimals, so wide decimal types keep every digit.
    """
    c = _col(c)
    x = _scaled(c, scale)
    message = F.concat(F.lit(f"more than {scale} decimals: "), c.cast("string"))
    exact = F.abs(x - F.rint(x)) <= F.lit(1e-6) + F.abs(x) * 4e-16
    wide = c.cast(f"decimal(38,{scale})") * F.lit(Decimal(10**scale))
    return (
        F.when(~exact, F.raise_error(message).cast("bigint"))
        .when(F.abs(x) < 1e15, F.rint(x).cast("bigint"))
        .otherwise(wide.cast("bigint"))
    )


def half_up(value: Column, digits: int) -> Column:
    """Drop ``digits`` decimal digits of a unit count, rounding half away from zero."""
    half = F.lit(10**digits // 2).cast("bigint")
    return int_div(value + F.when(value < 0, -half).otherwise(half), 10**digits)


def _line_cents(
    quantity: Column | str, unit_price: Column | str, discount: Column | str, times: int
) -> Column:
    """round(quantity * unit_price * (1 - discount)^times, 2) in cents.

    Prices and discounts in hundredths, the common case, stay in whole units. Others, up
    to four decimals, take the decimal formula, whose products fit 38 digits exactly.
    """
    price, off = _col(unit_price), _col(discount)
    keep = F.lit(100).cast("bigint") - F.rint(_scaled(off, 2)).cast("bigint")
    fast = _col(quantity).cast("bigint") * F.rint(_scaled(price, 2)).cast("bigint")
    slow = _col(quantity).cast("decimal(7,0)") * price.cast("decimal(16,4)")
    rest = (F.lit(Decimal(1)) - off.cast("decimal(5,4)")).cast("decimal(6,4)")
    for _ in range(times):
        fast, slow = fast * keep, slow * rest
    message = F.concat(F.lit("price or discount with more than 4 decimals: "), price.cast("string"))
    small = F.abs(_scaled(price, 2)) < 1e15
    return (
        F.when(is_exact(price, 2) & is_exact(off, 2) & small, half_up(fast, 2 * times))
        .when(is_exact(price, 4) & is_exact(off, 4), (F.round(slow, 2) * 100).cast("bigint"))
        .when(price.isNotNull() & off.isNotNull(), F.raise_error(message).cast("bigint"))
    )


def revenue_cents(quantity: Column | str, unit_price: Column | str, discount: Column | str) -> Column:
    """round(quantity * unit_price * (1 - discount), 2) in cents."""
    return _line_cents(quantity, unit_price, discount, 1)


def contribution_cents(
    quantity: Column | str, unit_price: Column | str, discount: Column | str
) -> Column:
    """round(quantity * unit_price * (1 - discount)^2, 2) in cents: a discount counts twice."""
    return _line_cents(quantity, unit_price, discount, 2)


def fee_cents(amount: Column | str, rate_bps: Column | str, fixed_fee: Column | str) -> Column:
    """round(amount * rate_bps / 10000 + fixed_fee, 2) in cents, for amounts and fees of up
    to four decimals."""
    variable = units(amount, 4) * _col(rate_bps).cast("bigint")
    return half_up(variable + units(fixed_fee, 4) * F.lit(10_000).cast("bigint"), 6)


def as_money(cents: Column, precision: int = 18, on_overflow: str = "error") -> Column:
    """Cents as ``decimal(precision, 2)``; ``on_overflow`` is "error" or "null"."""
    value = cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))
    target = f"decimal({precision},2)"
    return value.try_cast(target) if on_overflow == "null" else value.cast(target)


def wide_sum(value: Column) -> Column:
    """Sum of bigint units as ``decimal(34,0)``, safe far past the bigint range.

    A third of 10^12 rows in one group can exceed 2^63 cents. Summing quotient and
    remainder apart keeps both sums in bigint (and in codegen) for any real row count.
    """
    high = F.sum(int_div(value, _SUM_BASE)).cast("decimal(20,0)")
    low = F.sum(value % F.lit(_SUM_BASE)).cast("decimal(20,0)")
    return (high * F.lit(Decimal(_SUM_BASE)) + low).cast("decimal(34,0)")


def money_sum(cents: Column, precision: int = 18) -> Column:
    """Exact sum of a cents column as ``decimal(precision, 2)``."""
    return money_total(wide_sum(cents), precision)


def money_total(total: Column, precision: int = 18) -> Column:
    """Emit a ``wide_sum`` (or a sum of such sums) as ``decimal(precision, 2)``."""
    return (total.cast("decimal(34,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def line_revenue(
    quantity: Column | str,
    unit_price: Column | str,
    discount: Column | str,
    precision: int = 12,
    on_overflow: str = "error",
) -> Column:
    """Line revenue as a decimal column."""
    return as_money(revenue_cents(quantity, unit_price, discount), precision, on_overflow)


def interchange_fee(amount: Column | str, rate_bps: Column | str, fixed_fee: Column | str) -> Column:
    """Interchange fee of one transaction as a decimal column."""
    return as_money(fee_cents(amount, rate_bps, fixed_fee), 18)
