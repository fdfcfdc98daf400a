"""Date arithmetic as Column expressions. Inputs may be timestamp or timestamp_ntz."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
DAYS_PER_MONTH = 30.436875
DAYS_PER_YEAR = 365.2425


def _micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days of a difference, rounded down: minus twelve hours is -1."""
    return F.floor(_micros(later, earlier) / F.lit(float(DAY_MICROS))).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    return _micros(later, earlier) / F.lit(float(DAY_MICROS))


def weeks_between(later: Column, earlier: Column) -> Column:
    return days_between(later, earlier) / F.lit(7.0)


def months_between_mean(later: Column, earlier: Column) -> Column:
    """Difference in mean Gregorian months."""
    return days_between(later, earlier) / F.lit(DAYS_PER_MONTH)


def years_between_mean(later: Column, earlier: Column) -> Column:
    return days_between(later, earlier) / F.lit(DAYS_PER_YEAR)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def iso_weekday(ts: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(ts) + F.lit(1)


def day_third(hour: Column) -> Column:
    """1 before 08:00, 2 until 18:00, 3 afterwards or unknown."""
    return F.when(hour < 8, 1).when(hour < 18, 2).otherwise(3)


def day_quarter(hour: Column) -> Column:
    """2 from 06:00, 3 from 12:00, 4 from 18:00 to 22:59; the rest, and unknown, is 1."""
    return (
        F.when((hour >= 6) & (hour < 12), 2)
        .when((hour >= 12) & (hour < 18), 3)
        .when((hour >= 18) & (hour < 23), 4)
        .otherwise(1)
    )


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Timestamp, or null where the text is not one."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
