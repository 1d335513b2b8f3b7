"""Luhn check digits as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Card numbers have at most 19 digits (ISO/IEC 7812); one more keeps the width even.
MAX_DIGITS = 20


def _digit_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a digit string, which doubles every second digit from the right.

    The string is padded to a fixed width, so each place has a fixed weight and the sum
    is straight-line generated code. A doubled digit above 9 loses 9; (d + 3) >> 3 is one
    exactly for the digits 5 to 9.
    """
    text = F.lpad(digits, MAX_DIGITS, "0")
    places = []
    for from_right in range(MAX_DIGITS):
        d = F.ascii(F.substring(text, MAX_DIGITS - from_right, 1)) - ord("0")
        if (from_right % 2 == 0) == double_last:
            d = d * 2 - F.shiftright(d + 3, 3) * 9
        places.append(d)
    return reduce(lambda a, b: a + b, places)


def luhn_digit(body: Column | str) -> Column:
    """The check digit to append to a digit string; NULL for one of more than 20 digits."""
    body = F.col(body) if isinstance(body, str) else body
    digit = ((F.lit(10) - _digit_sum(body, double_last=True) % 10) % 10).cast("string")
    return F.when(F.length(body) <= MAX_DIGITS, digit)


def luhn_valid(number: Column | str) -> Column:
    """True for two to nineteen digits that end in their own check digit; NULL is not a
    card number."""
    number = F.col(number) if isinstance(number, str) else number
    # The sum stands first: Spark shares common subexpressions only in the part of a
    # condition that is always evaluated.
    valid = (_digit_sum(number, double_last=False) % 10 == 0) & number.rlike("^[0-9]{2,19}$")
    return F.coalesce(valid, F.lit(False))
