"""Registered queries: each runs library steps or a whole report on derived tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanbook import (
    benchmark_reconciliation,
    first_payment_profile,
    orphan_loans_by_month,
    paid_vs_expected,
    repayment_behaviour,
)
from loanbook.functions import rules
from loanbook.functions.dates import local_month_end, reporting_periods, with_calendar
from loanbook.functions.money import amount, ratio, units
from loanbook.operators.agents import (
    earliest_links,
    reassigned_agents,
    reassigned_since,
    sales_span_by_id,
    sales_span_by_name,
)
from loanbook.operators.payer import associators, payment_sources, senders
from loanbook.operators.payments import UGANDA, Country, daily_payments
from loanbook.operators.rates import with_month_end_rate
from loanbook.operators.relational import keep_listed, lookup, pick
from loanbook.operators.snapshots import (
    carried_over_calendar,
    join_prior_month_end,
    latest_per_period,
)
from loanbook.operators.usual import monthly_payments, payment_statistics
from loanbook.plans.first_payments import best_loan_per_customer
from loanbook.plans.paid_vs_expected import benchmark_arm, metered_arm, snapshot_arm
from loanbook.plans.repayment import ZAMBIA, join_snapshots, snapshot_terms, usual_payments
from workload.staging import AS_OF, StagedTables

PERIODS = reporting_periods(AS_OF)
Query = Callable[[SparkSession, str], DataFrame]


#: Tables that a query reads several times over, and that cost shuffles to derive.
KEPT = {
    name: ("snapshot_days",)
    for name in (
        "usual_payment_amount",
        "repayment_behaviour",
        "repayment_behaviour_mid_month",
        "repayment_behaviour_ordered",
        "repayment_behaviour_naive_local",
        "snapshot_vs_previous_month",
    )
}


def _on_tables(step: Callable[[StagedTables], DataFrame], kept: Sequence[str] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = StagedTables(spark, sf_dir)
        for name in kept:
            tables.keep(name)
        return step(tables)

    return run


# --- paid against expected -------------------------------------------------


def mtd_calendar(t) -> DataFrame:
    """Each country's calendar days of the three periods, with Uganda's payments per day."""
    paid = daily_payments(t, PERIODS).groupBy("payment_date").agg(
        F.count("*").alias("payments")
    )
    countries = t["customers"].groupBy("country").agg(F.count("*").alias("customers"))
    named = countries.withColumn(
        "period", F.explode(F.array(*[F.lit(p.name) for p in PERIODS]))
    )
    days = with_calendar(named, PERIODS, "generated_date")
    return days.join(
        paid,
        (F.col("generated_date") == F.col("payment_date")) & (F.col("country") == UGANDA.code),
        "left",
    ).select(
        "country",
        "customers",
        "period",
        "generated_date",
        F.coalesce("payments", F.lit(0)).alias("payments"),
    )


def latest_snapshot_per_loan(t) -> DataFrame:
    return latest_per_period(
        t["benchmark_days"], PERIODS, day="benchmark_date", loan="loan_id"
    ).select("period", "loan_id", "benchmark_date", "loan_state", "days_elapsed")


def carry_forward_calendar(t) -> DataFrame:
    days = t["metered_days"].select("loan_id", "benchmark_date", "days_elapsed")
    return carried_over_calendar(
        days, PERIODS, day="benchmark_date", loan="loan_id", report_day="report_date"
    )


def paid_vs_expected_actual_or_latest(t) -> DataFrame:
    paid = daily_payments(t, PERIODS)
    return metered_arm(t, PERIODS, paid).unionByName(benchmark_arm(t, PERIODS, paid))


def expected_schedule_admin(t) -> DataFrame:
    return snapshot_arm(t, PERIODS, daily_payments(t, PERIODS))


def month_end_rate(t) -> DataFrame:
    loans = t["loan_accounts"].join(
        pick(t["customers"], "cd", "customer_id", "country"),
        F.col("customer_id") == F.col("cd_customer_id"),
        "left",
    )
    rows = loans.select(
        F.col("loan_account_id").alias("loan_id"),
        F.to_date("handover_at_utc").alias("report_date"),
        F.col("cd_country").alias("country"),
        *[F.lit(None).cast("string").alias(c) for c in ("product", "team_lead", "region")],
    )
    return with_month_end_rate(rows, t["fx_rates"]).select(
        "loan_id", "report_date", "country", "eom_rate_usd"
    )


def prior_month_end_lookup(t) -> DataFrame:
    days = t["benchmark_days"].select("loan_id", "benchmark_date")
    reports = pick(
        t["benchmark_finance_monthly"], "l", "loan_id", "report_date", "loan_contract_end_date"
    )
    return join_prior_month_end(
        days, reports, ("loan_id", "l_loan_id"), "benchmark_date", "l_report_date"
    ).select(
        "loan_id",
        "benchmark_date",
        F.col("l_report_date").alias("prior_month_end"),
        F.col("l_loan_contract_end_date").alias("loan_contract_end_date"),
    )


# --- first payments --------------------------------------------------------


def normalised_key_join(t) -> DataFrame:
    people = pick(t["persons"], "sp", "person_id", "primary_phone")
    sent = t["payments"].select("id", rules.international_phone(F.col("sender")).alias("phone"))
    return sent.join(people, F.col("phone") == F.col("sp_primary_phone"), "left").select(
        "id", "phone", F.col("sp_person_id").alias("person_id")
    )


def right_join_null_rejecting(t) -> DataFrame:
    """A right join whose filter rejects NULLs, so it keeps matched rows only."""
    accounts = pick(t["loan_accounts"], "la", "loan_account_id", "customer_id", "source")
    due = t["first_payments"].select("loan_id", "customer_id", "first_payment_due")
    return (
        accounts.join(
            due,
            (F.col("la_loan_account_id") == F.col("loan_id"))
            & (F.col("la_customer_id") == F.col("customer_id")),
            "right",
        )
        .where(F.col("la_source") == "admin")
        .select("loan_id", "customer_id", "first_payment_due")
    )


# --- repayment behaviour ---------------------------------------------------


def local_month_ends(t) -> DataFrame:
    zones = pick(t["country_timezones"], "ct", "iso_2_abbreviation", "default_timezone")
    paid = lookup(
        t["metered_transactions"],
        zones,
        on=[("country", "ct_iso_2_abbreviation")],
        spread_by=["loan_id", "id"],
    )
    return paid.groupBy(
        "country",
        local_month_end(F.col("added_at_utc"), F.col("ct_default_timezone")).alias("month_end"),
    ).agg(F.count("*").alias("transactions"))


def snapshot_vs_previous_month(t) -> DataFrame:
    """Month-end snapshots with the snapshot of the previous month, and both schedules."""
    at_end = t["snapshot_days"].where(
        F.col("snapshot_at") == F.last_day("snapshot_at")
    ).select(F.col("loan_account_id").alias("loan_id"), F.col("snapshot_at").alias("month_end"))
    accounts = t["loan_accounts"]
    accounts = accounts.select(*[F.col(c).alias(f"la_{c}") for c in accounts.columns])
    items = pick(
        t["order_items"].where(F.col("master_loan_item") == 1), "oi", "loan_account_id",
        "down_payment_days",
    )
    customers = t["customers"].select(
        F.col("customer_id").alias("cd_customer_id"), F.col("country").alias("customer_country")
    )
    rows = (
        join_snapshots(at_end.distinct(), t, date(1900, 1, 1))
        .join(accounts, F.col("loan_id") == F.col("la_loan_account_id"))
        .join(items, F.col("loan_id") == F.col("oi_loan_account_id"), "left")
        .join(customers, F.col("d_customer_id") == F.col("cd_customer_id"), "left")
    )
    rows, terms = rules.with_terms(rows, snapshot_terms())
    rate = units(F.col("la_daily_rate"))
    return rows.select(
        "loan_id",
        "month_end",
        F.col("m_snapshot_at").alias("previous_at"),
        (units(F.col("m_outstanding_amount")) - units(F.col("d_outstanding_amount"))).alias(
            "paid_mtd"
        ),
        rules.expected_month_to_date(terms, rate).alias("expected_mtd"),
        rules.expected_ongoing_month_to_date(terms, rate).alias("expected_ongoing_mtd"),
    )


def product_segments(t) -> DataFrame:
    return t["product_mapping"].select(
        "product_type",
        "wattage",
        rules.product_segment(F.col("wattage"), F.col("product_type")).alias("segment"),
    )


# --- orphans ---------------------------------------------------------------


def known_by_date_match(t) -> DataFrame:
    return (
        t["benchmark_finance_monthly"]
        .select("loan_id", "customer_id", "report_date")
        .join(reassigned_since(t), F.col("customer_id") == F.col("oc_customer_id"), "left")
        .select(
            "loan_id",
            "report_date",
            F.coalesce(F.col("reassigned_at") <= F.col("report_date"), F.lit(False)).alias("known"),
        )
    )


# --- reconciliation, joins, numbers ----------------------------------------


def listed_loans(t) -> DataFrame:
    """Loans whose benchmark history lacks the state 'active': the ids to look into."""
    return (
        t["benchmark_days"]
        .groupBy(F.col("loan_id").alias("loan_account_id"))
        .agg(F.count_if(F.col("loan_state") == "active").alias("active_days"))
        .where(F.col("active_days") == 0)
        .select("loan_account_id")
    )


def reconcile_at_month_end(t) -> DataFrame:
    return benchmark_reconciliation(t, listed_loans(t))


def id_list_semi_join(t) -> DataFrame:
    return keep_listed(
        t["loan_accounts"], "loan_account_id", listed_loans(t), "loan_account_id"
    ).select("loan_account_id", "state", "source")


def left_join_residual(t) -> DataFrame:
    """Days join the sale only once its introduction is over; earlier days stay."""
    sales = pick(t["metered_sales"], "sd", "loan_id", "account_id", "introductory_period")
    return (
        t["metered_days"]
        .join(
            sales,
            (F.col("loan_id") == F.col("sd_loan_id"))
            & (F.col("account_id") == F.col("sd_account_id"))
            & (F.col("days_elapsed") > F.col("sd_introductory_period")),
            "left",
        )
        .select(
            "loan_id",
            "benchmark_date",
            "days_elapsed",
            F.col("sd_introductory_period").alias("introductory_period"),
        )
    )


def left_join_left_side_predicate(t) -> DataFrame:
    """A condition on the left row in ON: it blocks the match, not the row."""
    cases = pick(t["sales_cases"], "sc", "sales_case_id", "finalized")
    return (
        t["order_items"]
        .join(
            cases,
            (F.col("sales_case_id") == F.col("sc_sales_case_id"))
            & (F.col("sc_finalized") == 1)
            & (F.col("master_loan_item") == 1),
            "left",
        )
        .select("sales_order_item_id", "master_loan_item", F.col("sc_finalized").alias("finalized"))
    )


def cents_and_rounding(t) -> DataFrame:
    loans = t["loan_accounts"]
    return loans.select(
        "loan_account_id",
        units(F.col("initial_installment")).alias("installment"),
        F.round(
            rules.contract_rate(
                F.col("daily_rate"), F.col("initial_installment"), F.col("installment_period_days")
            )
        ).alias("rate"),
        ratio(F.col("amount_remaining"), F.col("installment_period_days")).alias("per_day"),
        rules.light_days(amount(F.col("amount_remaining")), F.col("daily_rate")).alias("light"),
    )


def registered() -> dict[str, Query]:
    steps: dict[str, Callable[[StagedTables], DataFrame]] = {
        "mtd_calendar": mtd_calendar,
        "daily_payments_unified": lambda t: daily_payments(t, PERIODS),
        "latest_snapshot_per_loan": latest_snapshot_per_loan,
        "carry_forward_calendar": carry_forward_calendar,
        "paid_vs_expected_actual_or_latest": paid_vs_expected_actual_or_latest,
        "expected_schedule_admin": expected_schedule_admin,
        "paid_vs_expected_periods": lambda t: paid_vs_expected(t, AS_OF),
        # The 1st takes the payments of a month without calendar days; Kenya's span reaches both
        # sides of its rule change, and like Tanzania it has regions and first days of its own.
        "paid_vs_expected_first_of_month": lambda t: paid_vs_expected(t, date(2024, 4, 1)),
        "paid_vs_expected_kenya": lambda t: paid_vs_expected(
            t, date(2022, 3, 28), Country("KE", "Kenya")
        ),
        "paid_vs_expected_tanzania": lambda t: paid_vs_expected(t, AS_OF, Country("TZ", "Tanzania")),
        "month_end_rate": month_end_rate,
        "prior_month_end_lookup": prior_month_end_lookup,
        "payer_first_sale": payment_sources,
        "payer_per_phone": senders,
        "normalised_key_join": normalised_key_join,
        "associator_contact": associators,
        "best_item_per_customer": lambda t: best_loan_per_customer(t).select(
            "customer_id", "loan_account_id", "source"
        ),
        "three_system_profile": lambda t: first_payment_profile(t, AS_OF),
        "right_join_null_rejecting": right_join_null_rejecting,
        "usual_payment_amount": usual_payments,
        "payment_statistics": lambda t: payment_statistics(t, ZAMBIA),
        "monthly_payment_profile": lambda t: monthly_payments(
            t, ZAMBIA, date(2023, 12, 31), date(2024, 1, 15)
        ),
        "repayment_behaviour": repayment_behaviour,
        "repayment_behaviour_mid_month": lambda t: repayment_behaviour(
            t, since=date(2024, 1, 15)
        ),
        "repayment_behaviour_ordered": lambda t: repayment_behaviour(t, fix_admin_order=True),
        "repayment_behaviour_naive_local": lambda t: repayment_behaviour(t, admin_naive_local=True),
        "local_month_end": local_month_ends,
        "snapshot_vs_previous_month": snapshot_vs_previous_month,
        "product_segment": product_segments,
        "agent_sales_span_by_name": sales_span_by_name,
        "agent_sales_span_by_id": sales_span_by_id,
        "reassigned_span": reassigned_agents,
        "earliest_link": lambda t: earliest_links(t).select(
            "powerhub_entry_id", "fenixdb_entry_id", "inserted_at_utc"
        ),
        "orphan_by_month": lambda t: orphan_loans_by_month(t, AS_OF),
        "known_by_date_match": known_by_date_match,
        "reconcile_at_month_end": reconcile_at_month_end,
        "id_list_semi_join": id_list_semi_join,
        "left_join_residual": left_join_residual,
        "left_join_left_side_predicate": left_join_left_side_predicate,
        "cents_and_rounding": cents_and_rounding,
    }
    return {name: _on_tables(step, KEPT.get(name, ())) for name, step in steps.items()}
