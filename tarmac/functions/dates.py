"""Calendar fields of a flight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The years a nanosecond timestamp can hold in full.
FIRST_YEAR, LAST_YEAR = 1678, 2261


def date_of(year: Column, day: Column, month: int = 1) -> Column:
    """The date, or NULL when the parts do not name one (day 32, missing year)."""
    first = F.make_date(F.when(year.between(FIRST_YEAR, LAST_YEAR), year.cast("int")),
                        F.lit(month), F.lit(1))
    in_month = day.between(1, F.dayofmonth(F.last_day(first)))
    return F.when(in_month, F.date_add(first, day.cast("int") - 1))


def parsed_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """A date column of the file itself; bad text is NULL."""
    return F.try_to_date(text, pattern)


def weekday(date: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(date).cast("smallint")


def weekend_flag(dow: Column) -> Column:
    return F.coalesce(dow.isin(5, 6), F.lit(False)).cast("smallint")
