"""Decision rules, as expressions that hold in batch and on streams alike."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The rules' thresholds and points.
HISTORY = 50
MIN_HISTORY = 3
RATIO = 3.0
FLOOR = 500.0
WINDOW = "60 seconds"
MAX_VELOCITY = 5
VELOCITY_POINTS = 40
HIGH_AMOUNT = 4000.0
AMOUNT_POINTS = 50
ALERT_ABOVE = 70


def as_fraction(ratio: float) -> tuple[int, int]:
    """A ratio as written, such as 2.3, in whole numbers."""
    exact = Fraction(str(ratio))
    if max(abs(exact.numerator), exact.denominator) >= 10**9:
        raise ValueError(f"a ratio must have at most nine digits, got {ratio}")
    return exact.numerator, exact.denominator


def above_ratio(
    units: Column, n: Column, total: Column, min_n: int, ratio: float, floor_units: int
) -> Column:
    """More than ``ratio`` times the mean of ``n`` earlier amounts, and above a floor.

    With the ratio as a fraction p/q, the mean is compared as ``amount * n * q > p * total``:
    whole numbers have no rounding, so an amount at exactly the limit never counts.
    """
    p, q = as_fraction(ratio)
    limit = total.cast(DecimalType(20, 0)) * F.lit(p).cast(DecimalType(9, 0))
    scaled = (units.cast(DecimalType(18, 0)) * n.cast(DecimalType(9, 0))).cast(
        DecimalType(27, 0)) * F.lit(q).cast(DecimalType(9, 0))
    return (n >= min_n) & (scaled > limit) & (units > floor_units)


def above_zscore(
    units: Column, n: Column, total: Column, total_sq: Column, min_n: int, z: float
) -> Column:
    """More than ``z`` sample standard deviations above the mean of ``n`` amounts.

    Both sides are squared and multiplied out, which keeps them whole numbers:
    ``(n*x - s)^2 * (n - 1) > z^2 * n * (n*q - s^2)``.
    """
    wide = DecimalType(38, 0)
    n_, s = n.cast(DecimalType(9, 0)), total.cast(DecimalType(20, 0))
    q = total_sq.cast(wide)
    gap = (n_ * units.cast(DecimalType(18, 0)) - s).cast(DecimalType(19, 0))
    left = (gap * gap).cast(wide) * (n_ - 1).cast(DecimalType(9, 0))
    spread = ((n_ * q).cast(wide) - (s * s).cast(wide)).cast(wide)
    z_squared = Fraction(str(z)) ** 2
    if z_squared >= 10_000 or (z_squared * 10_000).denominator != 1:
        raise ValueError(f"z must be below 100 with at most two decimals, got {z}")
    right = (n_ * spread).cast(wide) * F.lit(str(float(z_squared))).cast(DecimalType(8, 4))
    return (n >= max(min_n, 2)) & (gap > 0) & (left > right)


def velocity_score(
    velocity: Column,
    amount: Column,
    max_velocity: int = MAX_VELOCITY,
    high_amount: float = HIGH_AMOUNT,
) -> Column:
    points = F.when(velocity > max_velocity, VELOCITY_POINTS).otherwise(0)
    return points + F.when(amount > high_amount, AMOUNT_POINTS).otherwise(0)
