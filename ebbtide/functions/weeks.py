"""Week and month keys.

A week key is the integer ``yyyyww``; week 1 starts on 1 January and every
later week seven days after the one before, so week 53 is short. A month key
is the integer ``yyyymm``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_key(day: Column) -> Column:
    """Week key of a date."""
    number = F.floor((F.dayofyear(day) - 1) / F.lit(7)).cast("int") + 1
    return (F.year(day) * 100 + number).cast("int")


def week_first_day(key: Column) -> Column:
    """First day of the numbered week."""
    year = F.floor(key / F.lit(100)).cast("int")
    days = (key - year * 100 - 1) * 7
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), days.cast("int"))


def week_minus(key: Column, weeks: int) -> Column:
    """Week key ``weeks`` weeks earlier."""
    return week_key(F.date_sub(week_first_day(key), 7 * weeks))


def iso_week_key(day: Column) -> Column:
    """ISO year and week as ``yyyyww``, always two week digits."""
    return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_first_day(key: Column) -> Column:
    year = F.floor(key / F.lit(100)).cast("int")
    return F.make_date(year, (key - year * 100).cast("int"), F.lit(1))


def month_minus(key: Column, months: int) -> Column:
    return month_key(F.add_months(month_first_day(key), -months))


# The same rules on driver-side scalars, for parameters that become literals.

def week_key_of(day: dt.date) -> int:
    return day.year * 100 + (day.timetuple().tm_yday - 1) // 7 + 1


def week_first_day_of(key: int) -> dt.date:
    return dt.date(key // 100, 1, 1) + dt.timedelta(days=7 * (key % 100 - 1))


def week_key_minus(key: int, weeks: int) -> int:
    return week_key_of(week_first_day_of(key) - dt.timedelta(days=7 * weeks))


def iso_week_key_of(day: dt.date) -> int:
    iso = day.isocalendar()
    return iso[0] * 100 + iso[1]


def month_key_minus(key: int, months: int) -> int:
    total = (key // 100) * 12 + key % 100 - 1 - months
    return (total // 12) * 100 + total % 12 + 1


def month_first_day_of(key: int) -> dt.date:
    return dt.date(key // 100, key % 100, 1)


def monday_of(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())
