from datetime import date, datetime

from pyspark.sql import functions as F

from loanbook.functions.dates import (
    calendar_days,
    local_month_end,
    month_ends_before,
    period_of_day,
    periods_looking_back_to,
    prior_month_end,
    reporting_periods,
    shift_months,
)


def days(as_of, **options):
    return {p.name: p for p in reporting_periods(as_of, **options)}


def test_month_shift_clamps_to_the_month_end():
    assert shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert shift_months(date(2023, 3, 30), -1) == date(2023, 2, 28)
    assert shift_months(date(2024, 2, 29), -12) == date(2023, 2, 28)
    assert shift_months(date(2024, 1, 15), -1) == date(2023, 12, 15)


def test_periods_end_yesterday():
    p = days(date(2024, 3, 31))
    assert p["current month"].days == (date(2024, 3, 1), date(2024, 3, 30))
    assert p["last month"].days == (date(2024, 2, 1), date(2024, 2, 29))
    assert p["last year"].days == (date(2023, 3, 1), date(2023, 3, 30))
    assert p["current month"].lookback == (date(2024, 2, 1), date(2024, 3, 30))
    assert p["last month"].lookback == p["last month"].days


def test_first_of_month_shows_last_month_without_payments():
    p = days(date(2024, 5, 1))
    assert p["current month"].days == (date(2024, 4, 1), date(2024, 4, 30))
    assert p["current month"].lookback == (date(2024, 4, 1), date(2024, 4, 30))
    assert p["current month"].paid is None
    assert p["last month"].days == (date(2024, 3, 1), date(2024, 3, 30))
    fixed = days(date(2024, 5, 1), payments_follow_calendar=True)
    assert fixed["current month"].paid == (date(2024, 4, 1), date(2024, 4, 30))


def test_leap_february():
    p = days(date(2024, 3, 1))
    assert p["current month"].days == (date(2024, 2, 1), date(2024, 2, 29))
    assert p["last year"].days == (date(2023, 2, 1), date(2023, 2, 28))


def test_month_ends_before_windows():
    windows = [(date(2024, 2, 1), date(2024, 3, 30)), (date(2024, 3, 1), date(2024, 3, 2))]
    assert month_ends_before(windows) == [date(2024, 1, 31), date(2024, 2, 29)]


def test_day_to_period_and_look_back(spark):
    periods = reporting_periods(date(2024, 3, 31))
    rows = [(date(2024, 3, 5),), (date(2024, 2, 29),), (date(2023, 3, 30),), (date(2023, 3, 31),)]
    df = spark.createDataFrame(rows, "day date").select(
        period_of_day(F.col("day"), periods).alias("period"),
        periods_looking_back_to(F.col("day"), periods).alias("back"),
        prior_month_end(F.col("day")).alias("before"),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("current month", ["current month"], date(2024, 2, 29)),
        ("last month", ["current month", "last month"], date(2024, 1, 31)),
        ("last year", ["last year"], date(2023, 2, 28)),
        (None, [], date(2023, 2, 28)),
    ]


def test_calendar_lists_every_day(spark):
    periods = reporting_periods(date(2024, 3, 31))
    df = spark.createDataFrame([("last month",)], "period string")
    found = df.select(calendar_days(F.col("period"), periods).alias("d")).first().d
    assert len(found) == 29 and found[0] == date(2024, 2, 1) and found[-1] == date(2024, 2, 29)


def test_local_time_moves_the_month(spark):
    late = datetime(2024, 1, 31, 22, 30)
    rows = [(late, "Africa/Lusaka"), (late, "Africa/Abidjan"), (late, None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, zone string")
    ends = df.select(
        local_month_end(F.col("ts"), F.col("zone")).alias("utc"),
        local_month_end(F.col("ts"), F.col("zone"), naive_local=True).alias("local"),
    ).collect()
    assert [r.utc for r in ends] == [date(2024, 2, 29), date(2024, 1, 31), None]
    assert [r.local for r in ends] == [date(2024, 1, 31), date(2024, 1, 31), None]
