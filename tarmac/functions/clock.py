"""Clock times written as HHMM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MINUTES = 1440


def hhmm_to_minutes(value: Column) -> Column:
    """Minutes of the day from a numeric HHMM value, NULL outside 0..1439.

    Hour and minute are floor quotient and remainder by 100; the minute part is
    not checked (1275 gives 795) and 2400 is out of range.
    """
    whole = value == F.floor(value)
    # Kept in doubles: integer arithmetic on a junk value would overflow and raise.
    minutes = F.floor(value / 100).cast("double") * 60 + F.pmod(value, F.lit(100.0))
    return F.when(whole & minutes.between(0, DAY_MINUTES - 1), minutes.cast("int"))


def cyclic(minutes: Column, period: int = DAY_MINUTES) -> tuple[Column, Column]:
    angle = minutes.cast("double") * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle).cast("float"), F.cos(angle).cast("float")


def hour_of(minutes: Column) -> Column:
    return F.floor(minutes / 60).cast("int")
