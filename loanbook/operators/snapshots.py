"""Newest daily row per loan, carried over the calendar days of each period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.dates import (
    Period,
    periods_looking_back_to,
    prior_month_end,
    with_calendar,
    within_any,
)
from loanbook.operators.relational import newest_row


def latest_per_period(
    daily: DataFrame, periods: Sequence[Period], day: str, loan: str
) -> DataFrame:
    """Newest row per loan within each period's look-back, with a ``period`` column.

    A day can lie in two look-backs, so a row may stand for two periods. The
    daily table is read once for all of them.
    """
    tagged = daily.where(within_any(F.col(day), [p.lookback for p in periods])).withColumn(
        "period", F.explode(periods_looking_back_to(F.col(day), periods))
    )
    return newest_row(tagged, ["period", loan], [F.col(day)])


def carried_over_calendar(
    daily: DataFrame, periods: Sequence[Period], day: str, loan: str, report_day: str
) -> DataFrame:
    """The newest row of each loan, repeated for every calendar day of its period."""
    return with_calendar(latest_per_period(daily, periods, day, loan), periods, report_day)


def join_prior_month_end(
    daily: DataFrame, month_ends: DataFrame, loan: tuple[str, str], day: str, month_end: str
) -> DataFrame:
    """Left join each day to the report of the last day of the month before."""
    mine, theirs = loan
    return daily.join(
        month_ends,
        (F.col(mine) == F.col(theirs)) & (prior_month_end(F.col(day)) == F.col(month_end)),
        "left",
    )


def actual_or_carried(actual: str, carried: str) -> Column:
    """The value of the actual day, or the carried one when that day has none."""
    return F.coalesce(F.col(actual), F.col(carried))
