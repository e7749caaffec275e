"""Time-of-day columns from an ``H:MM`` slot string. Built-in expressions only (no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def slot_hour(ts) -> Column:
    """Leading part of ``H:MM`` as int; a non-numeric part raises under ANSI casts."""
    return F.split(_c(ts), ":").getItem(0).cast("int")


def slot_minute(ts) -> Column:
    """Second part of ``H:MM`` as int, 0 when absent (``get`` is null-safe where ``[1]`` raises under ANSI)."""
    return F.coalesce(F.get(F.split(_c(ts), ":"), 1).cast("int"), F.lit(0))


def slot_minutes(ts) -> Column:
    return slot_hour(ts) * 60 + slot_minute(ts)


def slot_label(minutes) -> Column:
    """Render minutes of the day as ``H:MM`` (hour not padded, minutes padded to two digits)."""
    m = _c(minutes)
    return F.format_string("%d:%02d", F.floor(m / 60).cast("int"), (m % 60).cast("int"))


def in_hours(hour, lo: int, hi: int) -> Column:
    return _c(hour).between(lo, hi)


# Inclusive hour ranges of the time-of-day flags.
MORNING_PEAK = (7, 9)
EVENING_PEAK = (17, 19)
MIDDAY = (11, 14)
LATE_NIGHT_FROM = 23
LATE_NIGHT_TO = 4


def time_flags(hour) -> dict[str, Column]:
    h = _c(hour)
    morning = in_hours(h, *MORNING_PEAK)
    evening = in_hours(h, *EVENING_PEAK)
    return {
        "peak_hour": (morning | evening).cast("int"),
        "morning_peak": morning.cast("int"),
        "evening_peak": evening.cast("int"),
        "late_night": ((h >= LATE_NIGHT_FROM) | (h <= LATE_NIGHT_TO)).cast("int"),
        "midday": in_hours(h, *MIDDAY).cast("int"),
    }


def cyclic(value, period: float, name: str) -> dict[str, Column]:
    angle = F.lit(TWO_PI) * _c(value) / F.lit(float(period))
    return {f"sin_{name}": F.sin(angle), f"cos_{name}": F.cos(angle)}
