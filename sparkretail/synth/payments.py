"""Card payments with a solvable hot key, payment directories and the weekly rate card."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.functions.cards import luhn_digit
from sparkretail.functions.draws import (
    constant_list,
    constant_map,
    pick,
    pick_weighted,
    uniform,
    with_draws,
)
from sparkretail.operators.pricing import SCHEDULE_EPOCH, SCHEDULE_STEP_DAYS
from sparkretail.synth import reference_data as ref

FIRST_TS = dt.datetime(2024, 1, 1)
FACT_DAYS = 180
RATE_WEEKS = 130
OPEN_END = dt.date(2099, 12, 31)
LAST_DAY = FIRST_TS.date() + dt.timedelta(days=FACT_DAYS - 1)
FACT_WINDOW = (FIRST_TS.date(), LAST_DAY)
CARD_POOL = 80_000

# Draw streams of the payment columns.
STREAMS = {
    "u_country": 31, "u_mcc": 32, "u_response": 33, "u_entry": 34, "u_hot": 35, "u_sec": 36,
    "u_acquirer": 37, "u_channel": 38, "u_merchant": 39, "u_card": 40, "u_cross": 41,
    "u_alt": 42, "u_auth": 43, "u_settled": 44, "u_n1": 45, "u_n2": 46, "u_hot_mcc": 47,
}
MILLION = 1_000_000


def hot_key_probability(target: float, hot_mcc_share: float | None = None) -> float:
    """Probability of overwriting a row's key with the hot one, for a hot share ``target``.

    The independent draws of the three columns already give ``base``.
    """
    mcc, country, entry = ref.HOT_KEY
    mcc_share = 1 / len(ref.MCCS) if hot_mcc_share is None else hot_mcc_share
    country_share = dict(ref.COUNTRY_WEIGHTS)[country] / sum(w for _, w in ref.COUNTRY_WEIGHTS)
    entry_share = dict(ref.ENTRY_WEIGHTS)[entry] / sum(w for _, w in ref.ENTRY_WEIGHTS)
    base = mcc_share * country_share * entry_share
    if not base < target < 1:
        raise ValueError(f"hot key share must lie between {base:.6f} and 1")
    return (target - base) / (1 - base)


def padded(number: Column, width: int) -> Column:
    """Zero-padded to at least ``width`` digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def card_number(index: Column) -> Column:
    """Synthetic 16-digit number with a valid check digit, from a pool index."""
    body = F.concat(F.lit("400000"), F.lpad(index.cast("string"), 9, "0"))
    return F.concat(body, luhn_digit(body))


def payments(
    keys: DataFrame,
    hot_share: float | None = None,
    hot_mcc_share: float | None = None,
    wide: bool = True,
    keep: tuple[str, ...] = (),
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """One card payment per row of ``keys``.

    ``hot_mcc_share`` puts that share on one merchant category, ``hot_share`` puts that
    share on one (category, country, entry mode) key. ``keep`` carries columns of
    ``keys`` along; ``columns`` limits the payment columns that are built at all.
    """
    u = {name: F.col(name) for name in STREAMS}

    def mcc() -> Column:
        if hot_mcc_share is None:
            return forced(ref.HOT_KEY[0], pick(u["u_mcc"], [m[0] for m in ref.MCCS]))
        others = [m[0] for m in ref.MCCS if m[0] != ref.HOT_KEY[0]]
        hot = u["u_hot_mcc"] % MILLION < int(hot_mcc_share * MILLION)
        return forced(ref.HOT_KEY[0], F.when(hot, ref.HOT_KEY[0]).otherwise(pick(u["u_mcc"], others)))

    def forced(hot: str, drawn: Column) -> Column:
        if hot_share is None:
            return drawn
        limit = int(hot_key_probability(hot_share, hot_mcc_share) * MILLION)
        return F.when(u["u_hot"] % MILLION < limit, hot).otherwise(drawn)

    def amount() -> Column:
        normal = F.sqrt(F.lit(-2.0) * F.log(uniform(u["u_n1"]))) * F.cos(
            F.lit(2 * math.pi) * uniform(u["u_n2"])
        )
        cents = F.floor(F.exp(F.lit(6.5) + F.lit(1.1) * normal))
        bounded = F.least(F.greatest(cents, F.lit(1)), F.lit(5 * MILLION))
        return (bounded / F.lit(100.0)).cast("decimal(14,2)")

    def txn_ts() -> Column:
        second = (u["u_sec"] % (FACT_DAYS * 86_400)).cast("int")
        return F.timestamp_add("SECOND", second, F.lit(FIRST_TS).cast("timestamp_ntz"))

    def merchant_country() -> Column:
        other = pick(u["u_alt"], [c[0] for c in ref.COUNTRIES])
        return F.when(u["u_cross"] % 100 < 12, other).otherwise(country)

    country, approved = F.col("country_code"), F.col("response_code") == "00"
    # Other columns look at these two, so they are built first.
    first = {
        "country_code": lambda: forced(ref.HOT_KEY[1], pick_weighted(u["u_country"], ref.COUNTRY_WEIGHTS)),
        "response_code": lambda: pick_weighted(u["u_response"], ref.RESPONSE_WEIGHTS),
    }
    build = {
        "txn_id": lambda: F.concat(F.lit("TXN"), padded(F.col("key"), 12)),
        "txn_ts": txn_ts,
        "amount": amount,
        "currency_code": lambda: F.element_at(constant_map(ref.COUNTRY_CURRENCY), country),
        "country_code": lambda: country,
        "mcc": mcc,
        "merchant_id": lambda: F.concat(F.lit("MID"), padded(u["u_merchant"] % 49_999 + 1, 7)),
        "acquirer_bin": lambda: pick(u["u_acquirer"], [a[0] for a in ref.ACQUIRERS]),
        "response_code": lambda: F.col("response_code"),
        "entry_mode": lambda: forced(ref.HOT_KEY[2], pick_weighted(u["u_entry"], ref.ENTRY_WEIGHTS)),
        "channel": lambda: pick_weighted(u["u_channel"], ref.PAYMENT_CHANNELS),
    }
    if wide:
        build |= {
            "card_number": lambda: card_number(u["u_card"] % CARD_POOL),
            "merchant_country": merchant_country,
            "auth_code": lambda: F.when(approved, padded(u["u_auth"] % MILLION, 6)).otherwise(""),
            "settled": lambda: approved & (u["u_settled"] % 100 < 94),
        }
    else:
        build["card_token"] = lambda: F.concat(F.lit("tok_"), padded(u["u_card"] % CARD_POOL + 1, 8))
    wanted = columns or tuple(build)
    base = with_draws(keys, "key", STREAMS).withColumns({n: make() for n, make in first.items()})
    return base.select(*[build[n]().alias(n) for n in wanted], *keep)


def rate_card(
    spark: SparkSession,
    weeks: int = RATE_WEEKS,
    epoch: dt.date = SCHEDULE_EPOCH,
    step_days: int = SCHEDULE_STEP_DAYS,
) -> DataFrame:
    """Weekly interchange rates for every (category, country, entry mode); the last week
    is open-ended.

    The combinations are the digits of one running number in a mixed radix, so the card
    is a narrow projection of a range: no join multiplies anything out.
    """
    n_mcc, n_country, n_entry = len(ref.MCCS), len(ref.COUNTRIES), len(ref.ENTRY_MODES)
    per_week = n_mcc * n_country * n_entry
    n = F.col("id")

    def digit(below: int, size: int) -> Column:
        return (F.floor(n / below) % size).cast("int")

    def at(values: list, index: Column) -> Column:
        type_ = "int" if isinstance(values[0], int) else "string"
        return F.element_at(constant_list(values, type_), index + 1)

    indexed = spark.range(weeks * per_week).select(
        (n + 1).alias("number"),
        F.floor(n / per_week).cast("int").alias("w"),
        digit(n_country * n_entry, n_mcc).alias("m"),
        digit(n_entry, n_country).alias("c"),
        digit(1, n_entry).alias("e"),
    )
    w, m, c, e = (F.col(x) for x in "wmce")
    category = at([x[2] for x in ref.MCCS], m)
    entry = at([x[0] for x in ref.ENTRY_MODES], e)
    start = F.date_add(F.lit(epoch), w * step_days)
    bps = (
        at([ref.BASE_BPS[x[2]] for x in ref.MCCS], m)
        + at([ref.ENTRY_BPS[x[0]] for x in ref.ENTRY_MODES], e)
        + at([ref.RISK_BPS[x[3]] for x in ref.COUNTRIES], c)
        + w % 5
        - 2
    )
    return indexed.select(
        F.concat(F.lit("IC"), padded(F.col("number"), 9)).alias("rate_id"),
        at([x[0] for x in ref.MCCS], m).alias("mcc"),
        at([x[0] for x in ref.COUNTRIES], c).alias("country_code"),
        entry.alias("entry_mode"),
        start.alias("effective_from"),
        F.when(w == weeks - 1, F.lit(OPEN_END))
        .otherwise(F.date_add(start, step_days - 1))
        .alias("effective_to"),
        bps.cast("int").alias("rate_bps"),
        ((F.col("number") % 8 + 5) / F.lit(1000.0)).cast("decimal(6,4)").alias("fixed_fee"),
        F.concat_ws(
            "-",
            F.upper(F.substring(category, 1, 4)),
            F.upper(F.substring(entry, 1, 4)),
            F.concat(F.lit("W"), padded(w, 2)),
        ).alias("program_code"),
        F.concat(
            at([x[1] for x in ref.COUNTRIES], c), F.lit(" "),
            F.initcap(F.replace(category, F.lit("_"), F.lit(" "))), F.lit(" "), entry,
            F.lit(ref.PROGRAM_WEEK), padded(w, 2), F.lit(ref.PROGRAM_PURPOSE),
        ).alias("program_name"),
    )


def directories(spark: SparkSession) -> dict[str, DataFrame]:
    """The six small code tables of the payment network."""
    return {
        "country": spark.createDataFrame(
            ref.COUNTRIES, "country_code STRING, country_name STRING, region STRING, risk_tier STRING"
        ),
        "mcc": spark.createDataFrame(ref.MCCS, "mcc STRING, mcc_description STRING, category STRING"),
        "currency": spark.createDataFrame(
            ref.CURRENCIES, "currency_code STRING, currency_name STRING, minor_units TINYINT"
        ),
        "response_code": spark.createDataFrame(
            ref.RESPONSE_CODES, "response_code STRING, meaning STRING, is_approved BOOLEAN"
        ),
        "entry_mode": spark.createDataFrame(
            ref.ENTRY_MODES, "entry_mode STRING, description STRING"
        ),
        "acquirer": spark.createDataFrame(
            ref.ACQUIRERS, "acquirer_bin STRING, acquirer_name STRING, country_code STRING"
        ),
    }
