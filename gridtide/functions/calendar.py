"""Date and time helpers. All work on DATE / TIMESTAMP_NTZ fields, so no session time zone enters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as fixed
from .classify import bucket, truth
from .keys import as_column


def to_ntz(text: Column | str) -> Column:
    """Text to TIMESTAMP_NTZ; NULL when it cannot be read."""
    return as_column(text).try_cast("timestamp_ntz")


def date_id(date: Column | str) -> Column:
    return F.date_format(as_column(date), "yyyyMMdd")


def date_from_id(column: Column | str) -> Column:
    return F.to_date(as_column(column), "yyyyMMdd")


def month_date(period: Column | str) -> Column:
    """First day of a 'YYYY-MM' period; NULL when the text is no such month."""
    return F.concat(as_column(period), F.lit("-01")).try_cast("date")


def start_of_hour(timestamp: Column | str) -> Column:
    ts = as_column(timestamp)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def weekday(date: Column | str) -> Column:
    """0 is Sunday."""
    return F.dayofweek(as_column(date)) - 1


def season(date: Column | str) -> Column:
    month = F.month(as_column(date))
    return bucket([(month.isin(months), name) for name, months in fixed.SEASONS])


def is_holiday(date: Column | str, offsets: tuple[int, int] = fixed.FLOATING_HOLIDAY_OFFSETS) -> Column:
    """Fixed-day holidays, and the weekday holiday whose day lies ``offsets`` days after the month's first."""
    d = as_column(date)
    month, day = F.month(d), F.dayofmonth(d)
    floating_month, floating_weekday = fixed.FLOATING_HOLIDAY
    flag = (month == floating_month) & (weekday(d) == floating_weekday) & (day - 1).between(*offsets)
    for holiday_month, holiday_day in fixed.FIXED_HOLIDAYS:
        flag = flag | ((month == holiday_month) & (day == holiday_day))
    return truth(flag)


def minute_number(timestamp: Column | str) -> Column:
    """Whole minutes since 1970."""
    ts = as_column(timestamp)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed: 00:00:30 to 00:01:10 is 1."""
    return minute_number(end) - minute_number(start)
