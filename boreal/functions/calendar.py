"""Calendar predicates and circular distances as Column expressions.

Range predicates are written against the raw date/timestamp column with date literals (never
``year(col) BETWEEN ..``), so the parquet scan receives them as pushed filters and skips row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_range(date_col, first_year: int | None = None, last_year: int | None = None) -> Column:
    """``first_year <= year(date) <= last_year``, as a pushable range on the column itself; a bound
    that is None leaves that side open. A NULL date is outside every range, an open one included."""
    c = _col(date_col)
    inside = c.isNotNull()
    if first_year is not None:
        inside = inside & (c >= F.lit(dt.date(first_year, 1, 1)))
    if last_year is not None and last_year < dt.MAXYEAR:
        inside = inside & (c < F.lit(dt.date(last_year + 1, 1, 1)))
    elif last_year is not None:  # no literal for the day after: year 10000 is written out
        inside = inside & (c < F.to_date(F.lit(f"+{last_year + 1}-01-01")))
    return inside


def before_within_days(date_col, target: dt.date, days: int) -> Column:
    """Strictly before ``target`` (by calendar day) and at most ``days`` days older."""
    c = _col(date_col)
    return (c < F.lit(target)) & (c >= F.lit(target - dt.timedelta(days=days)))


def is_leap_year(year) -> Column:
    y = _col(year)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def seasonal_day_distance(date_col, target: dt.date | Column, wrap_leap: bool = True,
                          exact_half: bool = True) -> Column:
    """Circular distance in days between a date's day of year and the target's (a date or a column of
    dates), in the date's year.

    The target is moved into the reading's year; a 29 February target becomes 28 February in a
    common year. The distance wraps around the year end (1 January is 1 day from 31 December).

    ``wrap_leap=False`` and ``exact_half=False`` reproduce the recorded forecasts, which did not wrap
    in leap years and turned a raw distance of 182 into 183 in common years.
    """
    c = _col(date_col)
    y = F.year(c)
    month, day = (F.month(target), F.dayofmonth(target)) if isinstance(target, Column) else (
        F.lit(target.month), F.lit(target.day))
    last_dom = F.dayofmonth(F.last_day(F.make_date(y, month, F.lit(1))))
    target_doy = F.dayofyear(F.make_date(y, month, F.least(day, last_dom)))
    diff = F.abs(F.dayofyear(c) - target_doy)
    leap_year = is_leap_year(y)
    if wrap_leap and exact_half:
        return F.least(diff, F.when(leap_year, 366).otherwise(365) - diff)
    common = F.least(diff, 365 - diff) if exact_half else \
        F.when(diff < 182, diff).otherwise(365 - diff)
    leap = F.least(diff, 366 - diff) if wrap_leap else diff
    return F.when(leap_year, leap).otherwise(common)


def circular_hour_distance(hour_a, hour_b) -> Column:
    """Hours apart on a 24-hour clock (hour fields only), at most 12."""
    a = _col(hour_a)
    b = hour_b if isinstance(hour_b, Column) else (
        F.col(hour_b) if isinstance(hour_b, str) else F.lit(int(hour_b)))
    d = F.abs(a - b)
    return F.when(d <= 12, d).otherwise(24 - d)


def hour_of_time(time_col) -> Column:
    """Hour field of an ``HH:MM:SS`` string; minutes and seconds are dropped; NULL if it is no number."""
    return F.substring_index(_col(time_col), ":", 1).try_cast("int")
