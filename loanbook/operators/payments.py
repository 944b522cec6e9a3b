"""Payments of the three systems in one shape, one row per customer, loan and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.dates import Period, within_any
from loanbook.functions.money import amount, units

# Transaction types that count as money in or out.
BENCHMARK_PAYMENT_TYPES = ("Loan Payment", "Loan Transaction Reversal")
METERED_PAYMENT_TYPES = (
    "Payment",
    "Reversal",
    "Transfer",
    "Automatic Arrears Payment",
    "Refund",
)
BOOKING_PAYMENT_TYPES = ("PaymentChargeTransaction", "RescueChargeTransaction")


@dataclass(frozen=True)
class Country:
    """How one country is named in the different tables."""

    code: str
    name: str

    @property
    def loan_prefix(self) -> str:
        return self.code.lower()


UGANDA = Country("UG", "Uganda")


def _per_day(
    df: DataFrame, loan_id: str, paid_at: str, value: Column, to_units
) -> DataFrame:
    totals = df.groupBy(
        "customer_id",
        F.col(loan_id).alias("loan_id"),
        F.to_date(paid_at).alias("payment_date"),
    ).agg(F.sum(value).alias("total"))
    return totals.select(
        "customer_id", "loan_id", "payment_date", to_units(F.col("total")).alias("amount_paid")
    )


def daily_payments(
    tables: Mapping[str, DataFrame], periods: Sequence[Period], country: Country = UGANDA
) -> DataFrame:
    """Paid amounts in units on the days of all periods: one scan per system.

    Sums are taken in decimal and turned into doubles after, so they do not
    depend on the order of the rows.
    """
    windows = [p.paid for p in periods if p.paid]

    def on_paid_days(table: str, paid_at: str, types: Sequence[str], where: Column) -> DataFrame:
        return tables[table].where(
            within_any(F.to_date(paid_at), windows)
            & F.col("transaction_type").isin(*types)
            & where
        )

    portions = F.col("portion_interest") + F.col("portion_principal")
    benchmark = on_paid_days(
        "benchmark_transactions",
        "added_at_utc",
        BENCHMARK_PAYMENT_TYPES,
        F.col("loan_id").startswith(country.loan_prefix),
    )
    metered = on_paid_days(
        "metered_transactions",
        "added_at_utc",
        METERED_PAYMENT_TYPES,
        F.col("country") == country.code,
    )
    bookings = on_paid_days(
        "payment_bookings",
        "payment_at",
        BOOKING_PAYMENT_TYPES,
        F.col("loan_account_id").startswith(country.loan_prefix),
    )
    return (
        _per_day(benchmark, "loan_id", "added_at_utc", portions, units)
        .unionByName(_per_day(metered, "loan_id", "added_at_utc", portions, amount))
        .unionByName(
            _per_day(bookings, "loan_account_id", "payment_at", F.col("amount"), units)
        )
    )
