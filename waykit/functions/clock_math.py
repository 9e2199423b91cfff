"""Time as whole microseconds, and rounding that equals the numbers users know."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
LONGEST = 1e10  # seconds; anything beyond is no time that a route can take

_DEPARTURE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seconds_to_micros(seconds: Column) -> Column:
    """Whole microseconds, half to even, so that sums are exact in any order.

    Null for NaN, infinite and absurd values, which the callers treat as missing or as a fault.
    """
    usable = ~F.isnan(seconds) & (F.abs(seconds) <= LONGEST)
    return F.when(usable, F.rint(seconds * F.lit(float(MICROS))).cast("bigint"))


def micros_to_seconds(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(MICROS))


def clean_missing(text: Column) -> Column:
    """Null for the textual forms of a missing value (JSON NaN arrives as text)."""
    bare = F.trim(F.translate(text, '"', ""))
    return F.when(F.lower(bare).isin("nan", "nat", "none", "null", ""), None).otherwise(text)


def departure_timestamp(date: Column, time: Column) -> Column:
    """Strict date plus time of day as a zone-free timestamp; null when malformed."""
    text = F.concat(date, F.lit(" "), time)
    return F.when(text.rlike(_DEPARTURE_SHAPE), text.try_cast("timestamp_ntz"))


def window_timestamp(text: Column) -> Column:
    return clean_missing(text).try_cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp; no session time zone involved."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def from_epoch_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def round_tenth(x: Column) -> Column:
    """One decimal, as numpy rounds: scale, round half to even, scale back."""
    return F.rint(x * 10) / 10


def window_broken(arrival: Column, opens: Column, closes: Column) -> Column:
    """Early or late; both bounds are inclusive and nobody waits."""
    return (arrival < opens) | (arrival > closes)


def one_decimal(x: Column) -> Column:
    """Text with one decimal, rounded on the exact binary value, half to even.

    ``x * 10`` is itself rounded; its error, taken from the two halves of ``x``, settles apparent ties.
    """
    size = F.abs(x)
    scaled = size * 10
    wide = size * F.lit(134217729.0)
    high = wide - (wide - size)
    error = (high * 10 - scaled) + (size - high) * 10
    whole = F.floor(scaled)
    rest = scaled - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    tenths = whole + F.when(up, 1).otherwise(0)
    sign = F.when(x < 0, "-").otherwise("")
    return F.concat(
        sign, F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("bigint").cast("string")
    )
