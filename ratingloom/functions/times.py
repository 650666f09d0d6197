"""Calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Holiday dates as (month, day) (fixed values).
HOLIDAYS = [(12, 25), (1, 1), (7, 4)]
HOLIDAY_YEARS = range(2010, 2015)


def season(ts: Column) -> Column:
    """winter, spring, summer or fall by month."""
    month = F.month(ts)
    return (
        F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer").when(month.isin(9, 10, 11), "fall")
    )


def holiday_flag(ts: Column, years: Sequence[int] = HOLIDAY_YEARS, days: int = 3) -> Column:
    """1 within ``days`` days of a holiday of one of ``years``, else 0."""
    dates = F.array(*[
        F.make_timestamp(F.lit(y), F.lit(m), F.lit(d), F.lit(0), F.lit(0), F.lit(0))
        for y in years for m, d in HOLIDAYS
    ])
    span = F.expr(f"interval {days} days")
    return F.exists(dates, lambda h: ts.between(h - span, h + span)).cast("int")


def weekday(ts: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(ts)


def days_between(first: Column, last: Column) -> Column:
    """Elapsed days as a fraction."""
    return (F.unix_micros(last) - F.unix_micros(first)) / F.lit(86_400_000_000.0)


def whole_days(first: Column, last: Column) -> Column:
    """Elapsed whole days, rounded down."""
    return F.floor(days_between(first, last)).cast("long")
