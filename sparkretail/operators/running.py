"""Running totals, row numbers and neighbours in key order, with no task per key.

A window over a key sends all its rows to one task. Here a key with more rows than a task
should hold is cut into pieces of its order, and the window runs per piece. What a piece
needs from the pieces before it (how many rows, which sums, the last row) is one small row
per piece, made by an aggregate that combines map-side, and added afterwards. Without a
key the whole table is one such sequence: that is a global rank.

Cut points come from a sample of the hot keys, of bounded size for each piece. They decide
only how even the pieces are; every row is in exactly one piece and results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.sources.readers import scalar

SAMPLE = 16  # sampled rows for each piece
TASKS_PER_SLOT = 4


def task_share(df: DataFrame, least: int = 1_000) -> int:
    """Rows a task should hold: an even share for a few tasks on each core."""
    slots = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return max(least, math.ceil(scalar(df.agg(F.count(F.lit(1)))) / (slots * TASKS_PER_SLOT)))


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    found = F.lit(True)
    for k in keys:
        found &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return found


def cut_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows and where to cut them: ``_cuts``, rising
    positions in ``order``, in groups of about the root of their number, so that a row finds
    its piece in two short searches. None if there is no such key.

    There are at most rows / ``rows_per_task`` hot keys and as many cut points. They are
    found by two jobs at once and held by the driver, so plans that use them stay small.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task)
    hot = counts.select(
        *(F.col(k).alias(f"_hot_{k}") for k in keys), F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_parts"), "_n"
    )
    found = hot.collect()
    if not found:
        return None
    known = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
    # The share that leaves about SAMPLE rows for each piece, chosen by a hash of the row.
    share = F.greatest(F.floor(F.col("_n") / (F.col("_parts") * SAMPLE)), F.lit(1))
    sample = (
        df.select(*keys, F.struct(*order).alias("_place")).join(known, _same_key(keys, "_hot_"))
        .where(F.pmod(F.xxhash64("_place"), share) == 0)
    )
    listed = sample.groupBy(*(f"_hot_{k}" for k in keys), "_parts").agg(F.array_sort(F.collect_set("_place")).alias("_all"))
    # Every so-manieth sampled row begins a piece.
    at = F.transform(
        F.sequence(F.lit(1), F.col("_parts") - 1),
        lambda i: F.element_at("_all", (F.floor(i * F.size("_all") / F.col("_parts")) + 1).cast("int")),
    )
    width = F.ceil(F.sqrt(F.size("_points"))).cast("int")
    grouped = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("_points") / F.col("_width")).cast("int") - 1),
        lambda g: F.slice("_points", g * F.col("_width") + 1, F.col("_width")),
    )
    cuts = (
        listed.withColumn("_points", F.array_distinct(at)).withColumn("_width", width)
        .select(*(f"_hot_{k}" for k in keys), grouped.alias("_cuts"), "_width")
    )
    return df.sparkSession.createDataFrame(cuts.collect(), cuts.schema)


def in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``df`` with ``_piece``, how many cut points of its key are not behind a row, and
    ``_cut``, whether the key has any."""
    here = F.struct(*order)
    outer = F.size(F.filter("_cuts", lambda group: group[0] <= here))
    inner = F.size(F.filter(F.element_at("_cuts", F.greatest(outer, F.lit(1))), lambda c: c <= here))
    piece = F.when(F.col("_cuts").isNull() | (outer == 0), 0).otherwise((outer - 1) * F.col("_width") + inner)
    joined = df.join(F.broadcast(cuts), _same_key(keys, "_hot_"), "left")
    return joined.select(*df.columns, piece.cast("int").alias("_piece"), F.col("_cuts").isNotNull().alias("_cut"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, str] | None = None,
    number: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``df`` with running values per key in the rising order of the columns ``order``.

    ``totals`` maps new columns to the numeric columns they sum up to and with each row
    (nulls add nothing), ``number`` names a row number from 1, ``previous`` and
    ``following`` map new columns to columns of the row before and after, null at the ends.
    ``order`` should be unique within a key; it decides where keys are cut, so rows that
    agree in it stay together. Null keys are one key; nulls stand first. ``df`` is counted
    at once and read again by the result, so hand in files or a written table.
    """
    totals, previous, following = dict(totals or {}), dict(previous or {}), dict(following or {})
    names = [*totals, *([number] if number else []), *previous, *following]
    if clash := set(names) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    kept = df.columns
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    cuts = cut_points(df, keys, order, rows_per_task or task_share(df))
    if cuts is None:
        return _whole_keys(df, kept, keys, order, totals, number, previous, following)
    cut = in_pieces(df, keys, order, cuts)
    place = F.struct(*order)
    # One row for each piece of a key that is cut; keys in one piece need nothing from others.
    edge = {
        **{f"_before_{n}": F.max_by(F.struct(F.col(c)), place) for n, c in previous.items()},
        **{f"_after_{n}": F.min_by(F.struct(F.col(c)), place) for n, c in following.items()},
        **{f"_sum_{n}": F.sum(c) for n, c in totals.items()},
        "_rows": F.count(F.lit(1)),
    }
    pieces = cut.where("_cut").groupBy(*keys, "_piece").agg(*(c.alias(n) for n, c in edge.items()))
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        *(F.col(k).alias(f"_of_{k}") for k in keys),
        F.col("_piece").alias("_at"),
        *(F.sum(f"_sum_{n}").over(earlier).alias(f"_sum_{n}") for n in totals),
        F.sum("_rows").over(earlier).alias("_rows"),
        *(F.lag(f"_before_{n}").over(by_piece).alias(f"_before_{n}") for n in previous),
        *(F.lead(f"_after_{n}").over(by_piece).alias(f"_after_{n}") for n in following),
    )
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    local = cut.select(
        *cut.columns,
        *(F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_own_{n}") for n, c in totals.items()),
        F.row_number().over(inside).cast("bigint").alias("_row"),
        *(F.lag(F.struct(F.col(c))).over(inside).alias(f"_lag_{n}") for n, c in previous.items()),
        *(F.lead(F.struct(F.col(c))).over(inside).alias(f"_lead_{n}") for n, c in following.items()),
    )
    joined = local.join(
        F.broadcast(carried), _same_key(keys, "_of_") & (F.col("_piece") == F.col("_at")), "left"
    )

    def added(own: str, carry: str) -> Column:
        both = F.coalesce(F.col(own), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
        return F.when(F.col(own).isNotNull() | F.col(carry).isNotNull(), both)

    return joined.select(
        *kept,
        *(added(f"_own_{n}", f"_sum_{n}").alias(n) for n in totals),
        *([(F.col("_row") + F.coalesce("_rows", F.lit(0))).alias(number)] if number else []),
        *(F.coalesce(f"_lag_{n}", f"_before_{n}")[c].alias(n) for n, c in previous.items()),
        *(F.coalesce(f"_lead_{n}", f"_after_{n}")[c].alias(n) for n, c in following.items()),
    )


def _whole_keys(df, kept, keys, order, totals, number, previous, following) -> DataFrame:
    """``running`` if no key has to be cut: plain windows."""
    window = Window.partitionBy(*keys).orderBy(*order)
    through = window.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        *(F.sum(c).over(through).alias(n) for n, c in totals.items()),
        *([F.row_number().over(window).cast("bigint").alias(number)] if number else []),
        *(F.lag(c).over(window).alias(n) for n, c in previous.items()),
        *(F.lead(c).over(window).alias(n) for n, c in following.items()),
    ).select(*kept, *totals, *([number] if number else []), *previous, *following)


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank", rows_per_task: int | None = None) -> DataFrame:
    """``df`` with the place of each row in the rising order of ``order``, from 1. No task
    numbers more than a share of the rows."""
    return running(df, [], order, number=name, rows_per_task=rows_per_task)
