"""Exact money arithmetic and the decimal encodings found in change records."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

PLAIN_NUMBER = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*$"


def money(value: Column, scale: int = 2) -> Column:
    """``value`` as an exact decimal, so that sums do not depend on row order."""
    return value.cast(DecimalType(18, scale))


def minor_units(value: Column, scale: int = 2) -> Column:
    """``value`` as whole units of ``10**-scale`` in a long (cents for scale 2)."""
    return (money(value, scale) * F.lit(10**scale)).cast("long")


def from_minor_units(units: Column, scale: int = 2) -> Column:
    return units.cast("double") / F.lit(float(10**scale))


def addable(units: Column) -> Column:
    """``units`` as a decimal, whose sums widen where a long would overflow."""
    return units.cast(DecimalType(18, 0))


def as_money(total: Column, scale: int = 2) -> Column:
    """A sum of whole units as a decimal with ``scale`` digits."""
    return total * F.lit(Decimal(1).scaleb(-scale))


def base64_decimal(encoded: Column, scale: int = 2) -> Column:
    """A base64 big-endian two's-complement integer, divided by ``10**scale``.

    Up to 16 bytes are read. The hex digits are sign-extended to 32, split into
    two 64-bit halves and put together as ``high * 2**64 + low``. The result is
    null for text that is not base64, for longer integers and for values beyond
    38 digits.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    negative = F.substring(digits, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    padded = F.when(negative, F.lpad(digits, 32, "F")).otherwise(F.lpad(digits, 32, "0"))
    two_64 = F.lit(str(2**64)).cast(DecimalType(20, 0))

    def half(start: int) -> Column:
        return F.conv(F.substring(padded, start, 16), 16, 10).cast(DecimalType(20, 0))

    high = F.when(negative, half(1) - two_64).otherwise(half(1)).cast(DecimalType(20, 0))
    whole = F.try_add(F.try_multiply(high, two_64), half(17)).cast(DecimalType(38, 0))
    value = F.try_divide(whole, F.lit(10**scale).cast(DecimalType(scale + 1, 0)))
    fits = digits.isNotNull() & F.length(digits).between(1, 32)
    return F.when(fits, value.cast(DecimalType(38, scale)))


def any_decimal(text: Column, scale: int = 2, encoding: str = "auto") -> Column:
    """A decimal sent as a number, a numeric string or base64.

    ``auto`` reads whatever looks like a number as one. A base64 text can by
    chance consist of digits only, so name the encoding where it is known.
    """
    plain = text.try_cast(DecimalType(38, scale))
    if encoding == "plain":
        return plain
    if encoding == "base64":
        return base64_decimal(text, scale)
    if encoding != "auto":
        raise ValueError(f"unknown decimal encoding {encoding!r}")
    return F.when(text.rlike(PLAIN_NUMBER), plain).otherwise(base64_decimal(text, scale))
