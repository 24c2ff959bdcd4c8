"""Addresses, hex quantities and networks."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed


def topic_to_address(topic: Column) -> Column:
    return F.lower(F.concat(F.lit("0x"), F.right(topic, F.lit(40))))


def address_to_topic(address: Column) -> Column:
    return F.concat(F.lit("0x" + "0" * 24), F.lower(F.substring(address, 3, 64)))


def _hex_digits(quantity: Column) -> Column:
    return F.lpad(F.lower(F.substring(quantity, 3, 64)), 64, "0")


def is_hex_quantity(quantity: Column) -> Column:
    """Readable hex quantity of at most 124 bits. Plain string functions, no patterns: this
    runs on every raw log."""
    digits = _hex_digits(quantity)
    return F.coalesce(
        F.startswith(quantity, F.lit("0x")) & F.length(quantity).between(3, 66)
        & (F.substring(digits, 1, 33) == "0" * 33)
        & F.unhex(F.substring(digits, 33, 32)).isNotNull(), F.lit(False))


def hex_value(quantity: Column) -> Column:
    """Value of a quantity already known to be readable. ``conv`` works on 64 bits, so the
    word is read as two halves."""
    digits = _hex_digits(quantity)
    high = F.conv(F.substring(digits, 34, 15), 16, 10).cast("decimal(19,0)")
    low = F.conv(F.substring(digits, 49, 16), 16, 10).cast("decimal(20,0)")
    two_64 = F.lit("18446744073709551616").cast("decimal(20,0)")
    return (high * two_64 + low).cast("decimal(38,0)")


def hex_to_units(quantity: Column, on_error: str = "drop") -> Column:
    """Exact integer behind a hex quantity. Unreadable input gives null ("drop") or zero
    ("zero")."""
    missing = None if on_error == "drop" else 0
    return F.when(is_hex_quantity(quantity), hex_value(quantity)).otherwise(
        F.lit(missing).cast("decimal(38,0)"))


def is_burn(address: Column) -> Column:
    return F.lower(address).isin(*fixed.BURN_ADDRESSES)


def chain_name(network: Column) -> Column:
    key = F.lower(F.coalesce(network, F.lit("")))
    named = reduce(
        lambda acc, item: acc.when(key == item[0], item[1]),
        fixed.CHAIN_NAMES.items(),
        F.when(F.lit(False), F.lit(None)),
    )
    return named.when(key.startswith("solana"), "Solana").otherwise(
        F.when(key == "", fixed.UNNAMED_CHAIN).otherwise(network)
    )
