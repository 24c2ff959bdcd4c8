"""Coercion, rounding, clocks and unit arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def usd(units: Column) -> Column:
    """Base units of a 6-decimal asset to dollars."""
    return units.cast("double") / F.lit(1e6)


def to_number(text: Column) -> Column:
    """``"$1,234.5"`` to 1234.5; anything unreadable to null."""
    stripped = F.regexp_replace(F.replace(F.trim(text), F.lit(","), F.lit("")), r"^\$+", "")
    return F.when(stripped.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
                  stripped.try_cast("double"))


def to_bool(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin("true", "1", "yes"), F.lit(False))


def to_int(text: Column) -> Column:
    return F.trim(text).try_cast("double").try_cast("bigint")


def clamp01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def deviation(value: Column, reference: Column, kind: Column) -> Column:
    """Distance from the reference: basis points (``pct``) or the raw unit (``abs``)."""
    return F.when(
        kind == "pct", half_even(F.lit(10000.0) * (value - reference) / reference, 1)
    ).otherwise(half_even(value - reference, 4))


def call_cap(price: Column, ceiling: float = 0.01) -> Column:
    return F.least(half_even(price * 1.25 + 0.0001, 6), F.lit(ceiling))


def clean_charged(charged: Column, cap: Column) -> Column:
    """A charge far above the cap is response data, not a payment."""
    return F.when(charged <= cap * 2, charged)


def epoch_seconds(value: Column) -> Column:
    """Plausible epoch seconds out of a seconds or milliseconds reading."""
    seconds = F.when(value > 1e12, value / 1000.0).otherwise(value)
    return F.when((seconds > 1.6e9) & (seconds < 2.0e9), seconds)


def age_seconds(value: Column, as_of_epoch: float) -> Column:
    return half_even(F.lit(float(as_of_epoch)) - epoch_seconds(value), 1)


def days_since(day: Column, as_of: str, default: int = 999) -> Column:
    """Whole days from an ISO date to ``as_of``; unreadable dates give the default."""
    parsed = F.substring(day, 1, 10).try_cast("date")
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), parsed), F.lit(default))


def whole_days_since(stamp: Column, as_of: str) -> Column:
    """Days since an ISO timestamp, floored at zero, null when unreadable."""
    parsed = F.replace(F.substring(stamp, 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", parsed, F.lit(as_of).cast("timestamp_ntz"))
    return F.greatest(F.lit(0).cast("bigint"), F.floor(seconds / 86400))


def temperature_unit(key: Column, value: Column) -> Column:
    return (
        F.when(key.contains("_c") | key.contains("celsius") | key.contains("centigrade"), "C")
        .when(key.contains("_f") | key.contains("fahrenheit"), "F")
        .when(value.between(-60, 45), "C")
        .when(value.between(32, 130), "F")
        .otherwise("?")
    )


def to_fahrenheit(value: Column, unit: Column) -> Column:
    return F.when(unit == "F", value).otherwise(half_even(value * 9 / 5 + 32, 1))


def money_text(value: Column) -> Column:
    """Plain decimal text of an amount, without trailing zeros."""
    text = F.regexp_replace(value.cast("decimal(28,8)").cast("string"), r"0+$", "")
    return F.regexp_replace(text, r"\.$", "")
