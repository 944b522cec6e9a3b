"""Usual payment and payment statistics per loan and month, from one pass over the payments.

Payments are added up by loan, month and amount, and these by loan and month: once for the
amount paid most often and once for the statistics. Both come out of the same row, so no
payment table is read, shuffled or joined to its loans a second time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanbook.functions.dates import local_date
from loanbook.functions.money import ratio
from loanbook.operators.payments import BENCHMARK_PAYMENT_TYPES, BOOKING_PAYMENT_TYPES
from loanbook.operators.relational import pick

Tables = Mapping[str, DataFrame]

# Transaction type ids of the metered system that are payments.
METERED_PAYMENT_TYPE_IDS = (2, 18, 20, 24, 61)

METERED, BENCHMARK, SNAPSHOT = "metered", "benchmark", "snapshot"


@dataclass(frozen=True)
class Span:
    """Local days after ``after`` are read; those after ``usual_after`` make the usual amount."""

    after: date | None = None
    usual_after: date | None = None


def _with_zone(df: DataFrame, tables: Tables, country: str) -> DataFrame:
    """Add the country's time zone. Several zones of a country repeat the row.

    The zones are a scalar subquery of one array, so no row of ``df`` moves for them.
    """
    named = tables["country_timezones"].where(F.col("iso_2_abbreviation") == country)
    zones = named.agg(F.collect_list(F.struct("default_timezone")).alias("zones")).scalar()
    spread = df.withColumn("_zones", zones).withColumn("_zone", F.explode_outer("_zones"))
    return spread.withColumn("zone", F.col("_zone.default_timezone")).drop("_zones", "_zone")


def _in_local_months(df: DataFrame, paid_at: str, span: Span, naive_local: bool = False) -> DataFrame:
    """Add ``month_end`` of the local date and whether the usual amount counts the row; keep
    local dates of the span."""
    df = df.withColumn("local_day", local_date(F.col(paid_at), F.col("zone"), naive_local))
    if span.after is not None:
        df = df.where(F.col("local_day") > F.lit(span.after))
    counts = F.lit(True) if span.usual_after is None else F.col("local_day") > F.lit(span.usual_after)
    return df.select("*", F.last_day("local_day").alias("month_end"), counts.alias("counts")).drop("local_day")


def _reaching(paid_at: str, span: Span) -> Column:
    """UTC bound a day wider than the local one, which the scan can use."""
    if span.after is None:
        return F.lit(True)
    return F.to_date(paid_at) >= F.lit(span.after - timedelta(days=1))


def whole_months_after(since: date) -> date:
    """The bound that keeps every month of which some day is after ``since``, as a whole."""
    return (since + timedelta(days=1)).replace(day=1) - timedelta(days=1)


def metered_month_transactions(tables: Tables, country: str, span: Span) -> DataFrame:
    """Metered payments of one country with their local month end."""
    paid = tables["metered_transactions"].where(
        F.col("transaction_type_id").isin(*METERED_PAYMENT_TYPE_IDS)
        & (F.col("country") == country)
        & _reaching("added_at_utc", span)
    )
    paid = paid.select(
        "loan_id",
        "id",
        "added_at_utc",
        (F.col("portion_interest") + F.col("portion_principal")).alias("value"),
    )
    return _in_local_months(_with_zone(paid, tables, country), "added_at_utc", span)


def account_items(tables: Tables, country: str) -> DataFrame:
    """Loan accounts (``la_``) with the items (``oi_``) of their sales case, for one country."""
    accounts = pick(
        tables["loan_accounts"],
        "la",
        "loan_account_id",
        "sales_case_id",
        "loan_type",
        "handover_at_utc",
        "daily_rate",
        "loan_duration",
        "initial_installment",
        "installment_periods",
        "installment_period_days",
    )
    items = pick(
        tables["order_items"].where(F.col("country") == country),
        "oi",
        "sales_case_id",
        "loan_account_id",
        "product_name",
        "down_payment_days",
    )
    return accounts.join(items, F.col("la_sales_case_id") == F.col("oi_sales_case_id"))


def own_items(tables: Tables, country: str) -> DataFrame:
    """The items of a loan's case that are of that loan."""
    return account_items(tables, country).where(
        F.col("oi_loan_account_id") == F.col("la_loan_account_id")
    )


def items_per_loan(tables: Tables, country: str) -> DataFrame:
    """One row per loan with items: how many a join to them gives, and whether one is its own.

    These rows make the hash table of a join, so the payments beside them are not sorted for it.
    """
    items = account_items(tables, country)
    own = F.coalesce(F.col("oi_loan_account_id") == F.col("la_loan_account_id"), F.lit(False))
    per_loan = items.groupBy(F.col("la_loan_account_id").alias("item_loan_id")).agg(
        F.count("*").alias("copies"), F.max(own).alias("has_own")
    )
    return per_loan.hint("shuffle_hash")


def benchmark_month_transactions(tables: Tables, country: str, span: Span) -> DataFrame:
    """Benchmark payments, in cents, with their month end in the country's time."""
    paid = tables["benchmark_transactions"].where(
        F.col("transaction_type").isin(*BENCHMARK_PAYMENT_TYPES) & _reaching("added_at_utc", span)
    )
    paid = paid.select(
        "loan_id",
        "id",
        "added_at_utc",
        (F.col("portion_interest") + F.col("portion_principal")).alias("value"),
    )
    return _in_local_months(_with_zone(paid, tables, country), "added_at_utc", span)


def booking_month_transactions(
    tables: Tables, country: str, span: Span, naive_local: bool = False
) -> DataFrame:
    """Bookings of payments, in cents, with their month end in the country's time."""
    paid = tables["payment_bookings"].where(
        F.col("transaction_type").isin(*BOOKING_PAYMENT_TYPES)
        & _reaching("transaction_at", span)
    )
    paid = paid.select(
        F.col("loan_account_id").alias("loan_id"),
        F.col("payment_booking_id").alias("id"),
        "transaction_at",
        F.col("amount").alias("value"),
    )
    return _in_local_months(
        _with_zone(paid, tables, country), "transaction_at", span, naive_local
    )


# What is left of the payments of one amount, and how it adds up over the amounts of a month.
_SPREAD = {"largest": F.max, "smallest": F.min, "summed": F.sum, "valued": F.sum}


def _spread_of_values() -> list[Column]:
    return [
        F.max("value").alias("largest"),
        F.min("value").alias("smallest"),
        F.sum("value").alias("summed"),
        F.count("value").alias("valued"),
    ]


def _amounts(paid: DataFrame, rounded: Column, times: Column, ids: Column, *more: Column) -> DataFrame:
    """One row per loan, month and rounded amount: ``times`` for the usual amount and whether
    any row counts for it, ``ids`` for the number of transactions, and the values' spread."""
    return paid.groupBy("loan_id", "month_end", rounded.alias("trans_amount")).agg(
        times.alias("times"), F.max("counts").alias("counts"), ids.alias("ids"), *_spread_of_values(), *more
    )


def _amounts_of_ids(paid: DataFrame, rounded: Column) -> DataFrame:
    """As ``_amounts`` with every counted row for ``times`` and every different id for ``ids``.

    Rows of one id come first, so an id that was booked with several amounts stands under
    several; it counts under its smallest.
    """
    keys = ["loan_id", "month_end", "id"]
    per_id = paid.groupBy(*keys, rounded.alias("trans_amount")).agg(
        F.count_if("counts").alias("times"), F.max("counts").alias("counts"), *_spread_of_values()
    )
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("trans_amount")) == 1
    told = per_id.withColumn("new", first & F.col("id").isNotNull())
    return told.groupBy("loan_id", "month_end", "trans_amount").agg(
        F.sum("times").alias("times"),
        F.max("counts").alias("counts"),
        F.count_if("new").alias("ids"),
        *[add(name).alias(name) for name, add in _SPREAD.items()],
    )


def _by_month(amounts: DataFrame, system: str, divisor: int, copies: str | None = None) -> DataFrame:
    """Amounts of a month in one row: the most frequent one (the smaller on a tie, NULL last)
    with its ``times``, and count, largest, smallest and rounded mean of all payments.

    What the report joins later depends on the loan and the month, not on the amount, so it
    multiplies every amount's count alike and cannot change which one wins.
    """
    order = F.struct((-F.col("times")).alias("less"), F.col("trans_amount").isNull().alias("none"), "trans_amount")
    grouped = amounts.groupBy("loan_id", "month_end").agg(
        F.min(F.when(F.col("counts"), order)).alias("best"),
        (F.sum("ids") * (F.max(copies) if copies else F.lit(1))).alias("total_transactions"),
        *[add(name).alias(name) for name, add in _SPREAD.items()],
    )

    def in_units(column: str) -> Column:
        return F.col(column).cast("double") / F.lit(float(divisor))

    return grouped.select(
        F.lit(system).alias("system"),
        "loan_id",
        "month_end",
        F.col("best").isNotNull().alias("has_usual"),
        F.col("best.trans_amount").alias("trans_amount"),
        (-F.col("best.less")).alias("times"),
        "total_transactions",
        in_units("largest").alias("max_payment"),
        in_units("smallest").alias("min_payment"),
        F.round(ratio(in_units("summed"), F.col("valued")), 0).alias("avg_payment"),
    )


def _rounded_units() -> Column:
    return F.round(F.col("value").cast("double") / F.lit(100.0), 0)


def metered_months(tables: Tables, country: str, span: Span) -> DataFrame:
    """Metered: every transaction counts for the usual amount."""
    paid = metered_month_transactions(tables, country, span)
    rounded = F.round(F.col("value").cast("double"), 0)
    return _by_month(_amounts(paid, rounded, F.count_if("counts"), F.count("id")), METERED, 1)


def benchmark_months(tables: Tables, country: str, span: Span) -> DataFrame:
    """Benchmark: every different transaction counts for the usual amount. For the statistics a
    payment counts once per joined row: times the item rows and, as the daily finance table
    joins twice, times its rows squared."""
    paid = benchmark_month_transactions(tables, country, span)
    paid = paid.join(items_per_loan(tables, country), F.col("loan_id") == F.col("item_loan_id"))
    times = F.count_distinct(F.when(F.col("counts"), F.col("id")))
    amounts = _amounts(paid, _rounded_units(), times, F.count("id"), F.max("copies").alias("copies"))
    months = _by_month(amounts, BENCHMARK, 100, "copies")
    per_loan = tables["benchmark_finance_daily"].groupBy(F.col("loan_id").alias("finance_loan_id")).agg(
        F.count("*").alias("finance_rows")
    )
    squared = F.coalesce(F.col("finance_rows") * F.col("finance_rows"), F.lit(1))
    joined = months.join(per_loan, F.col("loan_id") == F.col("finance_loan_id"), "left")
    counted = joined.withColumn("total_transactions", F.col("total_transactions") * squared)
    return counted.select(*months.columns)


def booking_months(tables: Tables, country: str, span: Span, naive_local: bool = False) -> DataFrame:
    """Bookings: every booking of a loan with an item of its own counts for the usual amount,
    every different booking of a loan with any item for the statistics."""
    paid = booking_month_transactions(tables, country, span, naive_local)
    paid = paid.join(items_per_loan(tables, country), F.col("loan_id") == F.col("item_loan_id"))
    paid = paid.withColumn("counts", F.col("counts") & F.col("has_own"))
    return _by_month(_amounts_of_ids(paid, _rounded_units()), SNAPSHOT, 100)


def monthly_payments(
    tables: Tables,
    country: str,
    after: date | None = None,
    usual_after: date | None = None,
    naive_local: bool = False,
) -> DataFrame:
    """System, loan and local month: usual amount with its ``times``, and payment statistics.

    Each payment table is scanned once. Payments on local days after ``after`` (all, if not
    given) make the statistics, those after ``usual_after`` the usual amount; ``has_usual``
    tells the months that have any of these.
    """
    span = Span(after, usual_after)
    return (
        metered_months(tables, country, span)
        .unionByName(benchmark_months(tables, country, span))
        .unionByName(booking_months(tables, country, span, naive_local))
    )


STATISTICS = ("total_transactions", "max_payment", "min_payment", "avg_payment")


def payment_statistics(
    tables: Tables, country: str, since: date | None = None, naive_local: bool = False
) -> DataFrame:
    """Count, largest, smallest and mean payment per loan and local month, over all months
    or those after ``since``."""
    months = monthly_payments(tables, country, since, naive_local=naive_local)
    return months.select("loan_id", "month_end", *STATISTICS).distinct()


def payments_of_month(
    tables: Tables, country: str, since: date, naive_local: bool = False
) -> DataFrame:
    """Loan and month with what every system has for it, in one row.

    ``chosen`` has the usual amounts of payments after ``since`` and ``statistics`` the
    different statistics of the whole month; both have one entry per system at most. Statistics
    are found by loan and month whatever their system, so a row without either has none.
    """
    months = monthly_payments(tables, country, whole_months_after(since), since, naive_local)
    # By loan, so that what the systems know of a loan meets it where it lies. A loan has one
    # row per system and month here.
    grouped = months.repartition("loan_id").groupBy("loan_id", "month_end").agg(
        F.collect_list(F.when(F.col("has_usual"), F.struct("system", "loan_id", "trans_amount", "times"))).alias("chosen"),
        F.collect_set(F.struct(*STATISTICS)).alias("found"),
    )
    known = F.col("loan_id").isNotNull() & F.col("month_end").isNotNull()
    return grouped.select(
        "loan_id", "month_end", "chosen", F.when(known, F.array_sort("found")).alias("statistics")
    )


def usual_amounts(months: DataFrame, system: str, inner: bool = False) -> DataFrame:
    """One system's usual amount per loan and month, with its ``times`` and the ``statistics``.

    For left joins the rows lie by ``loan_id`` already. For an ``inner`` join the loan comes out of
    the array: the condition such a join puts on it then stays above the rows that all systems
    share.
    """
    entry = "_chosen.loan_id" if inner else "loan_id"
    spread = months.withColumn("_chosen", F.explode("chosen"))
    return spread.where(F.col("_chosen.system") == system).select(
        "month_end",
        "statistics",
        F.col(entry).alias("loan_id"),
        F.col("_chosen.trans_amount").alias("trans_amount"),
        F.col("_chosen.times").alias("times"),
    )
