"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensoria.catalogs import MONTH_NAMES


def period_label(month: Column) -> Column:
    """``'YYYY-MM'`` as the ``'<month name> YYYY'`` used in descriptions."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    parts = F.split(month, "-")
    number = F.element_at(parts, 2).cast("int")
    return F.concat_ws(" ", F.element_at(names, number), F.element_at(parts, 1))


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def day_exists(year: Column, month: Column, day: Column) -> Column:
    """Whether the day number is on the real calendar of that month."""
    return day <= F.dayofmonth(F.last_day(first_of_month(year, month)))


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """Date of a day number.

    Counts from the first of the month, so an impossible day (31 April) is no
    error when it is evaluated before :func:`day_exists` has filtered it out.
    """
    return F.date_add(first_of_month(year, month), day.cast("int") - F.lit(1))


def within_month(moment: Column, year: int, month: int) -> Column:
    """Half-open range test for one month; reaches Parquet row-group statistics."""
    first = dt.date(year, month, 1)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return (moment >= F.lit(first)) & (moment < F.lit(following))


def weekday(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - F.lit(1)


def is_weekend(day: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(day).isin(1, 7).cast("int")


def year_angle(day: Column) -> Column:
    """Position in the year as an angle; 31 Dec and 1 Jan end up side by side."""
    return F.lit(2 * math.pi) * F.dayofyear(day) / F.lit(365.25)


def months_ahead_in_days(last: Column, months: int) -> Column:
    """Days from ``last`` to the same day ``months`` calendar months later."""
    return F.datediff(F.add_months(last, months), last)
