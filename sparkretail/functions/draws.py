"""Reproducible pseudo-random draws from a row key.

A draw is a pure function of a non-negative integer key and a stream number, so the
same row gets the same value under any partitioning, after any task retry, and in any
other SQL engine. It is the minimal standard Lehmer generator, started at the key and
advanced by a fixed number of steps per stream: one multiplication and two remainders,
all below 2^63. The key occurs once in the expression, which keeps generated code small
when Catalyst copies a draw into a pushed-down filter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.money import int_div

# Fixed values of the generator.
MODULUS = 2_147_483_647  # 2^31 - 1
MULTIPLIER = 16_807
# Steps before the first stream, so that neighbouring keys are far apart.
WARM_UP = 1_000


def stream_factor(stream: int) -> int:
    """The generator's multiplier for ``WARM_UP + stream`` steps at once."""
    return pow(MULTIPLIER, WARM_UP + stream, MODULUS)


def draw(key: Column | str, stream: int) -> Column:
    """A value in [1, 2^31 - 2] from ``key``; different streams are unrelated."""
    key = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    start = key % F.lit(MODULUS - 1).cast("bigint") + 1
    return start * F.lit(stream_factor(stream)).cast("bigint") % F.lit(MODULUS).cast("bigint")


def with_draws(df: DataFrame, key: Column | str, streams: dict[str, int]) -> DataFrame:
    """Add one draw column per entry. Kept as its own projection, so that expressions
    which look at a draw many times do not repeat its arithmetic."""
    return df.withColumns({name: draw(key, stream) for name, stream in streams.items()})


def fenced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns that later steps look at many times.

    The new values leave as one struct per row, unrolled in place. Catalyst neither
    copies their expressions into a filter pushed below nor merges them into the next
    projection, so each is evaluated once per row and generated methods stay small
    enough for the JVM to compile.
    """
    kept = [c for c in df.columns if c not in columns]
    values = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    return df.select(*kept, F.inline(values)).select(*order)


def constant_list(values: Sequence[object], type_: str = "string") -> Column:
    """A constant array, folded to one literal at planning time. Building it from one
    ``lit`` per value would cost a call into the JVM for each. No value holds a comma."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{type_}>")


def constant_map(mapping: dict[str, str]) -> Column:
    """A constant string map, folded like ``constant_list``."""
    return F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in mapping.items())), F.lit(","), F.lit(":"))


def pick(u: Column, values: Sequence[str]) -> Column:
    """Equal-share choice from a list."""
    return F.element_at(constant_list(values), (u % F.lit(len(values)) + 1).cast("int"))


def pick_weighted(u: Column, weighted: Sequence[tuple[str, int]]) -> Column:
    """Choice by whole-number weights.

    A lookup in a constant list of slots, one per common divisor of the weights. A chain
    of comparisons would repeat ``u`` per value and, copied into filters, grow generated
    methods past what the JVM compiles.
    """
    unit = math.gcd(*[w for _, w in weighted])
    slots = [value for value, w in weighted for _ in range(w // unit)]
    slot = int_div(u % F.lit(len(slots) * unit), unit) + 1
    return F.element_at(constant_list(slots), slot.cast("int"))


def uniform(u: Column) -> Column:
    """A draw as a double strictly between 0 and 1."""
    return u / F.lit(float(MODULUS))
