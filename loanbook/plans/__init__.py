"""The five reports. Each takes the tables and a date and returns a DataFrame."""

from loanbook.plans.first_payments import first_payment_profile
from loanbook.plans.orphans import orphan_loans_by_month
from loanbook.plans.paid_vs_expected import paid_vs_expected
from loanbook.plans.reconciliation import benchmark_reconciliation
from loanbook.plans.repayment import repayment_behaviour

__all__ = [
    "benchmark_reconciliation",
    "first_payment_profile",
    "orphan_loans_by_month",
    "paid_vs_expected",
    "repayment_behaviour",
]
