"""Dates: the three reporting periods, month ends, local time."""

from __future__ import annotations

import calendar
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Window = tuple[date, date]

# Period labels of the report.
CURRENT_MONTH = "current month"
LAST_MONTH = "last month"
LAST_YEAR = "last year"


def shift_months(day: date, months: int) -> date:
    """``day`` moved by whole months; a day past the month's end is clamped."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def month_start(day: date) -> date:
    return day.replace(day=1)


@dataclass(frozen=True)
class Period:
    """One reporting period.

    ``days``      the calendar, first of the month to the last day, both included
    ``lookback``  where the newest daily row of a loan may come from
    ``paid``      days whose payments count, or None when no day does
    """

    name: str
    days: Window
    lookback: Window
    paid: Window | None


def reporting_periods(as_of: date, payments_follow_calendar: bool = False) -> list[Period]:
    """Month to date up to yesterday, the same span a month and a year before.

    The month to date takes payments of the month of ``as_of`` while its calendar
    ends yesterday, so on the 1st no payment falls on a calendar day. Set
    ``payments_follow_calendar`` to take the calendar's month instead.
    """
    yesterday = as_of - timedelta(days=1)
    month_ago = shift_months(yesterday, -1)
    year_ago = shift_months(yesterday, -12)
    to_date = (month_start(yesterday), yesterday)
    previous = (month_start(month_ago), month_ago)
    last_year = (month_start(year_ago), year_ago)
    same_month = month_start(as_of) == month_start(yesterday)
    return [
        Period(
            CURRENT_MONTH,
            days=to_date,
            lookback=(month_start(shift_months(as_of, -1)), yesterday),
            paid=to_date if same_month or payments_follow_calendar else None,
        ),
        Period(LAST_MONTH, days=previous, lookback=previous, paid=previous),
        Period(LAST_YEAR, days=last_year, lookback=last_year, paid=last_year),
    ]


def within(day: Column, window: Window) -> Column:
    return day.between(F.lit(window[0]), F.lit(window[1]))


def within_any(day: Column, windows: Iterable[Window]) -> Column:
    """True when ``day`` lies in one of the windows; plain ranges, so the scan can use them."""
    ranges = [within(day, window) for window in dict.fromkeys(windows)]
    return reduce(lambda a, b: a | b, ranges) if ranges else F.lit(False)


def period_of_day(day: Column, periods: Sequence[Period]) -> Column:
    """Name of the period whose calendar holds ``day`` (calendars never overlap)."""
    label = F.lit(None).cast("string")
    for period in reversed(periods):
        label = F.when(within(day, period.days), period.name).otherwise(label)
    return label


def periods_looking_back_to(day: Column, periods: Sequence[Period]) -> Column:
    """Array of the period names whose look-back holds ``day``."""
    names = [F.when(within(day, p.lookback), p.name) for p in periods]
    return F.filter(F.array(*names), lambda name: name.isNotNull())


def calendar_days(period: Column, periods: Sequence[Period]) -> Column:
    """Array of the calendar days of the named period (31 at most)."""
    first = last = F.lit(None).cast("date")
    for p in periods:
        first = F.when(period == p.name, F.lit(p.days[0])).otherwise(first)
        last = F.when(period == p.name, F.lit(p.days[1])).otherwise(last)
    return F.sequence(first, last)


def with_calendar(df: DataFrame, periods: Sequence[Period], day: str) -> DataFrame:
    """Repeat each row (which carries ``period``) over its period's calendar days."""
    return df.withColumn(day, F.explode(calendar_days(F.col("period"), periods)))


def month_ends_before(windows: Iterable[Window]) -> list[date]:
    """Last days of the months before each month touched by the windows."""
    ends = set()
    for first, last in windows:
        month = month_start(first)
        while month <= last:
            ends.add(month - timedelta(days=1))
            month = shift_months(month, 1)
    return sorted(ends)


def prior_month_end(day: Column) -> Column:
    """Last day of the month before ``day``."""
    return F.date_sub(F.trunc(day, "month"), 1)


def local_date(utc: Column, zone: Column, naive_local: bool = False) -> Column:
    """Calendar date of a UTC time in ``zone``; NULL when the zone is unknown.

    ``naive_local`` reads the time as local already and moves it to UTC instead.
    """
    from_zone, to_zone = (zone, F.lit("UTC")) if naive_local else (F.lit("UTC"), zone)
    return F.to_date(F.convert_timezone(from_zone, to_zone, utc))


def local_month_end(utc: Column, zone: Column, naive_local: bool = False) -> Column:
    return F.last_day(local_date(utc, zone, naive_local))
