"""Account system and finance system side by side for a list of loans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from loanbook.operators.relational import keep_listed, pick


def benchmark_reconciliation(
    tables: Mapping[str, DataFrame],
    loan_ids: DataFrame,
    with_benchmarks: bool = False,
) -> DataFrame:
    """Listed loans with both states at the month end of their last benchmark.

    ``loan_ids`` has a column ``loan_account_id``. ``with_benchmarks`` adds the
    state and elapsed days of the loan's benchmark of that last day.
    """
    accounts = keep_listed(
        tables["loan_accounts"], "loan_account_id", loan_ids, "loan_account_id"
    )
    finance = pick(
        tables["benchmark_finance_monthly"],
        "l",
        "loan_id",
        "report_date",
        "benchmark_date",
        "loan_state",
        "loan_cancelled_at_utc",
        "loan_completed_at_utc",
        "percent_locked",
        "par_days",
    )
    figures = pick(
        tables["benchmark_finance_calculations"],
        "c",
        "loan_id",
        "report_date",
        "remaining_all",
        "remaining_net_unfin",
        "accounts_receivable_all",
        "accounts_receivable_net_unfin",
    )
    rows = accounts.join(
        finance,
        (F.col("loan_account_id") == F.col("l_loan_id"))
        & (F.last_day("last_benchmark_date") == F.col("l_report_date")),
    ).join(
        figures,
        (F.col("loan_account_id") == F.col("c_loan_id"))
        & (F.col("l_report_date") == F.col("c_report_date")),
        "left",
    )
    extra = []
    if with_benchmarks:
        days = pick(
            tables["benchmark_days"], "b", "loan_id", "benchmark_date", "loan_state", "days_elapsed"
        )
        rows = rows.join(
            days,
            (F.col("loan_account_id") == F.col("b_loan_id"))
            & (F.col("last_benchmark_date") == F.col("b_benchmark_date")),
            "left",
        )
        extra = [
            F.col("b_loan_state").alias("benchmark_loan_state"),
            F.col("b_days_elapsed").alias("benchmark_days_elapsed"),
        ]
    return rows.select(
        "loan_account_id",
        "migrated_loan",
        F.col("l_report_date").alias("month_end"),
        F.col("last_benchmark_date").alias("last_benchmark_date_lad"),
        F.col("l_benchmark_date").alias("benchmark_date_finance"),
        F.col("state").alias("state_lad"),
        F.col("state_detailed").alias("state_detailed_lad"),
        F.col("l_loan_state").alias("loan_state"),
        F.coalesce("canceled_at_utc", "paid_off_at_utc").alias(
            "cancellation or completion date_lad"
        ),
        F.coalesce("l_loan_cancelled_at_utc", "l_loan_completed_at_utc").alias(
            "cancellation or completion date_finance"
        ),
        F.col("amount_remaining").cast("double").alias("amount_remaining"),
        F.col("c_remaining_all").cast("double").alias("remaining_all"),
        F.col("c_remaining_net_unfin").cast("double").alias("remaining_net_unfin"),
        F.col("percent_locked").alias("percent_locked_lad"),
        F.col("l_percent_locked").alias("percent_locked_finance"),
        F.col("par_days").alias("par_days_lad"),
        F.col("l_par_days").alias("par_days_finance"),
        "risk_category",
        "days_prepaid_remaining",
        "inserted_at_utc",
        F.col("c_accounts_receivable_all").cast("double").alias("ar"),
        F.col("c_accounts_receivable_net_unfin").cast("double").alias("ar_net_unfin"),
        *extra,
    )
