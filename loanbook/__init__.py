"""Loan-book analytics on Spark: five reports over three loan systems."""

from loanbook.plans import (
    benchmark_reconciliation,
    first_payment_profile,
    orphan_loans_by_month,
    paid_vs_expected,
    repayment_behaviour,
)

__all__ = [
    "benchmark_reconciliation",
    "first_payment_profile",
    "orphan_loans_by_month",
    "paid_vs_expected",
    "repayment_behaviour",
]
