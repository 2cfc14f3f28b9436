"""Event-time helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds per unit of a duration text.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(text: str) -> int:
    """``"60 seconds"`` as microseconds."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not match or match.group(2) not in UNIT_MICROS:
        raise ValueError(f"not a duration: {text!r}")
    return int(match.group(1)) * UNIT_MICROS[match.group(2)]


def micros(ts: Column) -> Column:
    """``ts`` as a long. A time without zone is read in the session's zone."""
    return F.unix_micros(ts.cast("timestamp"))


def event_time(epoch_millis: Column) -> Column:
    return F.timestamp_millis(epoch_millis)
