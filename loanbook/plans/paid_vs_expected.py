"""Paid against expected, day by day, for three periods and three systems.

The three periods run as one pipeline: their calendars never overlap, so the
period is a function of the day, and every table is scanned once for all three.
What differs between the periods stands in the join conditions and rules below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from loanbook.functions.dates import (
    CURRENT_MONTH,
    LAST_MONTH,
    Period,
    month_ends_before,
    period_of_day,
    reporting_periods,
    with_calendar,
    within,
    within_any,
)
from loanbook.functions.labels import ACCOUNT_SOURCE, CREDIT, PAID_COMPANY
from loanbook.functions.money import amount, units
from loanbook.functions.rules import (
    LoanTerms,
    area_region,
    expected_all,
    expected_by_contract,
    expected_in_repayment,
    rate_while_due,
    sale_region,
    with_terms,
)
from loanbook.operators.payments import UGANDA, Country, daily_payments
from loanbook.operators.places import hub_regions, with_area_manager, with_stock_point
from loanbook.operators.rates import with_month_end_rate
from loanbook.operators.relational import (
    keep_listed,
    left_join_nested,
    lookup,
    nested,
    newest_row,
    pick,
)
from loanbook.operators.snapshots import (
    actual_or_carried,
    join_prior_month_end,
    latest_per_period,
)

Tables = Mapping[str, DataFrame]

KEYS = [
    "company",
    "period",
    "report_date",
    "generated_date",
    "loan_contract_end_date",
    "new_loan_contract_end",
    "benchmark_date",
    "loan_id",
    "customer_id",
    "daily_rate",
    "loan_state",
    "new_loan_state",
    "in_repayment",
    "latest_in_repayment",
    "cancellation_reason",
    "product",
    "team_lead",
    "country",
    "region",
    "payment_date",
    "amount_paid",
]
MEASURES = ["expected_all_mtd", "expected_in_month_in_repayment"]


def _join_payments(df: DataFrame, paid: DataFrame, when) -> DataFrame:
    payments = pick(paid, "p", "loan_id", "payment_date", "amount_paid")
    on = (F.col("loan_id") == F.col("p_loan_id")) & (F.col("report_date") == F.col("p_payment_date"))
    return df.join(payments, on if when is None else on & when, "left")


def _beside(
    df: DataFrame, other: DataFrame, loan: str, day: str, periods: Sequence[Period], name: str
) -> DataFrame:
    """Put a loan's rows of each period beside the loan's row of the period, as an array."""
    keyed = other.select(
        "*", F.col(loan).alias("_loan"), period_of_day(F.col(day), periods).alias("_period")
    )
    rows = nested(keyed, ["_loan", "_period"], name)
    same = (F.col("loan_id") == F.col("_loan")) & (F.col("period") == F.col("_period"))
    return df.join(rows, same, "left").drop("_loan", "_period")


def _over_calendar(
    carried: DataFrame, actual: DataFrame, paid: DataFrame, periods: Sequence[Period], when
) -> DataFrame:
    """A loan's row of a period on each of its days, with the actual row and payments of the day.

    The loan's actual days and payments are met once per period; each day then looks its own
    up, so no join sees the rows that the calendar makes. Payments count where ``when`` holds.
    """
    payments = pick(paid, "p", "loan_id", "payment_date", "amount_paid")
    rows = _beside(carried, actual, "d_loan_id", "d_benchmark_date", periods, "actual")
    rows = _beside(rows, payments, "p_loan_id", "p_payment_date", periods, "payments")
    day = F.col("report_date")
    rows = left_join_nested(
        with_calendar(rows, periods, "report_date"),
        "actual",
        actual.columns,
        lambda row: row["d_benchmark_date"] == day,
    )
    return left_join_nested(
        rows,
        "payments",
        ["p_payment_date", "p_amount_paid"],
        lambda row: (row["p_payment_date"] == day) & when,
    )


def _days_of(periods: Sequence[Period]):
    return [p.days for p in periods]


def _lookbacks(periods: Sequence[Period]):
    return [p.lookback for p in periods]


def metered_daily(tables: Tables, periods: Sequence[Period]) -> DataFrame:
    """Daily metrics with the sale, once its introduction is over."""
    sales = pick(
        tables["metered_sales"],
        "sd",
        "loan_id",
        "account_id",
        "introductory_period",
        "loan_duration",
        "product_type",
        "associator_manager_name",
        "country_of_sale",
        "customer_id_fenixdb",
    )
    people = pick(tables["person_demographics"], "pd", "person_id", "district", "region")
    sales = sales.join(people, F.col("sd_customer_id_fenixdb") == F.col("pd_person_id"), "left")
    sales = sales.withColumn(
        "sd_region", sale_region(F.col("sd_country_of_sale"), F.col("pd_district"), F.col("pd_region"))
    ).drop("pd_person_id", "pd_district", "pd_region", "sd_customer_id_fenixdb")

    days = pick(
        tables["metered_days"].where(within_any(F.col("benchmark_date"), _lookbacks(periods))),
        "d",
        "loan_id",
        "account_id",
        "customer_id",
        "benchmark_date",
        "daily_rate",
        "in_repayment",
        "days_elapsed",
    )
    return days.join(
        sales,
        (F.col("d_loan_id") == F.col("sd_loan_id"))
        & (F.col("d_account_id") == F.col("sd_account_id"))
        & (F.col("d_days_elapsed") > F.col("sd_introductory_period")),
        "left",
    )


def _with_metered_report(
    daily: DataFrame, tables: Tables, periods: Sequence[Period]
) -> DataFrame:
    """Add the loan's report (``l_``) of the month end before the day."""
    month_ends = month_ends_before(_lookbacks(periods))
    reports = pick(
        tables["metered_finance_monthly"].where(F.col("report_date").isin(*month_ends)),
        "l",
        "loan_id",
        "report_date",
        "loan_contract_end_date",
        "loan_state",
    )
    return join_prior_month_end(
        daily, reports, ("d_loan_id", "l_loan_id"), "d_benchmark_date", "l_report_date"
    )


def metered_arm(
    tables: Tables, periods: Sequence[Period], paid: DataFrame, country: Country = UGANDA
) -> DataFrame:
    """Metered system: actual day, else the newest day carried forward."""
    daily = metered_daily(tables, periods)
    # One row per loan and period first; what else the carried row needs is joined to that.
    newest = latest_per_period(
        daily.where(F.col("sd_country_of_sale") == country.name),
        periods,
        day="d_benchmark_date",
        loan="d_loan_id",
    )
    reported = _with_metered_report(newest, tables, periods).select(
        "period",
        F.col("d_loan_id").alias("loan_id"),
        F.col("d_customer_id").alias("ll_customer_id"),
        F.col("l_loan_state").alias("ll_report_state"),
        F.col("d_daily_rate").alias("ll_daily_rate"),
        F.coalesce("d_in_repayment", F.lit(False)).alias("ll_in_repayment"),
        F.col("d_days_elapsed").alias("ll_days_elapsed"),
        F.col("l_loan_contract_end_date").alias("ll_loan_contract_end_date"),
        F.col("sd_product_type").alias("ll_product"),
        F.col("sd_associator_manager_name").alias("ll_team_lead"),
        F.col("sd_country_of_sale").alias("ll_country"),
        F.col("sd_region").alias("ll_region"),
    )
    carried = newest_row(reported, ["period", "loan_id"], [F.col("ll_days_elapsed")])

    # The month to date shows today's state of the loan, the others the reported one.
    states = pick(tables["metered_loans"], "sh", "loan_id", "loan_state")
    is_current = F.col("period") == CURRENT_MONTH
    carried = carried.join(
        states, (F.col("loan_id") == F.col("sh_loan_id")) & is_current, "left"
    ).drop("sh_loan_id")

    reasons = tables["metered_cancellations"].select(
        F.col("loan_id").alias("crh_loan_id"),
        F.to_date("change_recorded_at_utc").alias("crh_day"),
        F.col("cancellation_reason").alias("crh_reason"),
    )
    days = daily.where(within_any(F.col("d_benchmark_date"), _days_of(periods)))
    actual = _with_metered_report(days, tables, periods).join(
        reasons.where(within_any(F.col("crh_day"), _days_of(periods))),
        (F.col("d_loan_id") == F.col("crh_loan_id"))
        & (F.col("d_benchmark_date") == F.col("crh_day")),
        "left",
    )
    # Outside the month to date a payment needs the loan's actual row of that day.
    rows = _over_calendar(carried, actual, paid, periods, is_current | F.col("d_loan_id").isNotNull())

    rate = amount(actual_or_carried("d_daily_rate", "ll_daily_rate"))
    length, intro = F.col("sd_loan_duration"), F.col("sd_introductory_period")
    grouped = (
        rows.withColumn(
            "due_all",
            rate_while_due(
                actual_or_carried("d_days_elapsed", "ll_days_elapsed"), length, intro, rate
            ),
        )
        .withColumn(
            "due_actual",
            rate_while_due(F.col("d_days_elapsed"), length, intro, amount(F.col("d_daily_rate"))),
        )
        .groupBy(
            F.lit(PAID_COMPANY["metered"]).alias("company"),
            "period",
            "report_date",
            F.col("report_date").alias("generated_date"),
            F.col("l_loan_contract_end_date").alias("loan_contract_end_date"),
            F.col("ll_loan_contract_end_date").alias("new_loan_contract_end"),
            F.col("d_benchmark_date").alias("benchmark_date"),
            "loan_id",
            actual_or_carried("d_customer_id", "ll_customer_id").alias("customer_id"),
            rate.alias("daily_rate"),
            F.when(is_current, F.col("sh_loan_state"))
            .otherwise(F.col("l_loan_state"))
            .alias("loan_state"),
            F.when(is_current, F.col("sh_loan_state"))
            .otherwise(F.col("ll_report_state"))
            .alias("new_loan_state"),
            F.col("d_in_repayment").alias("in_repayment"),
            F.col("ll_in_repayment").alias("latest_in_repayment"),
            F.col("crh_reason").alias("cancellation_reason"),
            actual_or_carried("sd_product_type", "ll_product").alias("product"),
            actual_or_carried("sd_associator_manager_name", "ll_team_lead").alias("team_lead"),
            actual_or_carried("sd_country_of_sale", "ll_country").alias("country"),
            actual_or_carried("sd_region", "ll_region").alias("region"),
            F.col("p_payment_date").alias("payment_date"),
            F.col("p_amount_paid").alias("amount_paid"),
        )
        .agg(F.sum("due_all").alias("due_all"), F.sum("due_actual").alias("due_actual"))
    )
    return grouped.select(
        *KEYS,
        expected_by_contract(
            F.col("new_loan_contract_end"),
            F.coalesce("benchmark_date", "report_date"),
            F.col("daily_rate"),
            F.coalesce("in_repayment", "latest_in_repayment"),
            F.col("due_all"),
        ).alias("expected_all_mtd"),
        F.when(F.col("in_repayment"), F.col("due_actual"))
        .otherwise(F.lit(0.0))
        .alias("expected_in_month_in_repayment"),
    )


def _items_with_hub_region(items: DataFrame, tables: Tables, applies: str, case_id: str) -> DataFrame:
    """Items twice: as they are, and with their hub's region, told apart by ``applies``.

    The hub's region is wanted in one period only. Tagging the items keeps the
    daily rows, which are far more, out of the two joins that find it.
    """
    plain = items.withColumn(applies, F.lit(False)).withColumn(
        "loc_region", F.lit(None).cast("string")
    )
    regions = hub_regions(tables).drop("sc_hub_name")
    located = items.join(regions, F.col(case_id) == F.col("sc_sales_case_id"), "left").drop(
        "sc_sales_case_id"
    )
    return plain.unionByName(located.withColumn(applies, F.lit(True)))


def _snapshot_terms() -> LoanTerms:
    return LoanTerms(
        country=F.col("cd_country"),
        loan_type=F.col("la_loan_type"),
        state=F.col("d_state"),
        snapshot=F.col("report_date"),
        handover=F.col("la_handover_at_utc"),
        months_on_book=F.col("d_months_on_book"),
        terminated_at=F.col("d_terminated_at"),
        item_daily_rate=F.col("oi_daily_rate"),
        initial_installment=F.col("la_initial_installment"),
        period_days=F.col("la_installment_period_days"),
        periods=F.col("la_installment_periods"),
        loan_duration=F.col("oi_loan_duration"),
        down_payment_days=F.col("oi_down_payment_days"),
    )


def snapshot_arm(
    tables: Tables, periods: Sequence[Period], paid: DataFrame, country: Country = UGANDA
) -> DataFrame:
    """Snapshot system: the daily snapshot itself, expected amounts by schedule rules."""
    customers = pick(
        tables["customers"].where(F.col("country") == country.code),
        "cd",
        "customer_id",
        "country",
        "area1",
        "area2",
        "hub_id",
        "assigned_to_contractor_id",
    )
    customers = with_area_manager(customers, tables, "cd_area2", "cd_customer_id")
    customers = with_stock_point(customers, tables, "cd_hub_id", "cd_customer_id")
    accounts = pick(
        tables["loan_accounts"].where(
            (F.col("initial_installment") > 0) & (F.col("initial_amount") > 0)
        ),
        "la",
        "loan_account_id",
        "loan_contract_end_date",
        "initial_installment",
        "installment_period_days",
        "installment_periods",
        "loan_type",
        "handover_at_utc",
        "cancel_comment",
    )
    items = pick(
        tables["order_items"].where(
            (F.col("master_loan_item") == 1) & (F.col("account_type") == CREDIT)
        ),
        "oi",
        "loan_account_id",
        "customer_id",
        "sales_case_id",
        "daily_rate",
        "loan_duration",
        "down_payment_days",
        "product_line_name",
    )
    items = _items_with_hub_region(items, tables, "oi_current", "oi_sales_case_id")
    # The look-backs hold the calendars; with the days that the benchmark system asks for, the
    # managers are read once for both.
    managers = pick(
        tables["agent_managers"].where(within_any(F.col("benchmark_date"), _lookbacks(periods))),
        "ph",
        "sales_agent_id",
        "benchmark_date",
        "manager_name",
    )
    days = pick(
        tables["snapshot_days"].where(within_any(F.col("snapshot_at"), _days_of(periods))),
        "d",
        "loan_account_id",
        "customer_id",
        "snapshot_at",
        "state",
        "months_on_book",
        "terminated_at",
    ).withColumn("period", period_of_day(F.col("d_snapshot_at"), periods))

    # What a loan has, its account and the array of its items, is met once on the loan.
    item_columns = [c for c in items.columns if c != "oi_loan_account_id"]
    loans = accounts.join(
        nested(items, ["oi_loan_account_id"], "items"),
        F.col("la_loan_account_id") == F.col("oi_loan_account_id"),
        "left",
    ).drop("oi_loan_account_id")
    rows = lookup(
        days.join(customers, F.col("d_customer_id") == F.col("cd_customer_id")),
        managers,
        on=[
            ("cd_assigned_to_contractor_id", "ph_sales_agent_id"),
            ("d_snapshot_at", "ph_benchmark_date"),
        ],
        spread_by=["d_loan_account_id", "d_snapshot_at"],
    ).join(loans, F.col("d_loan_account_id") == F.col("la_loan_account_id"))
    is_current = F.col("period") == CURRENT_MONTH
    rows = (
        left_join_nested(
            rows,
            "items",
            item_columns,
            lambda item: (item["oi_customer_id"] == F.col("d_customer_id"))
            & (item["oi_current"] == is_current),
        )
        .withColumnRenamed("d_loan_account_id", "loan_id")
        .withColumnRenamed("d_snapshot_at", "report_date")
    )
    rows = _join_payments(rows, paid, None)

    rows, terms = with_terms(rows, _snapshot_terms())
    by_area = area_region(F.col("cd_country"), F.col("cd_area1"), F.col("cd_area2"))
    region = (
        F.when(F.col("period") != CURRENT_MONTH, by_area)
        .when(F.col("cd_country") == "TZ", F.col("am_region"))
        .when(F.col("cd_country") == "KE", F.col("sp_subcounty"))
        .when(F.col("cd_country") == "UG", F.col("loc_region"))
        .otherwise(by_area)
    )
    team_lead = F.when(F.col("cd_country") == "TZ", F.col("am_manager")).otherwise(
        F.col("ph_manager_name")
    )
    return (
        rows.withColumn("expected_day", expected_all(terms))
        .withColumn("expected_day_in_repayment", expected_in_repayment(terms))
        .groupBy(
            F.lit(PAID_COMPANY["snapshot"]).alias("company"),
            "period",
            "report_date",
            F.col("report_date").alias("generated_date"),
            F.col("la_loan_contract_end_date").alias("loan_contract_end_date"),
            F.col("la_loan_contract_end_date").alias("new_loan_contract_end"),
            F.col("report_date").alias("benchmark_date"),
            "loan_id",
            F.col("d_customer_id").alias("customer_id"),
            terms.daily_rate.alias("daily_rate"),
            F.lower("d_state").alias("loan_state"),
            F.lower("d_state").alias("new_loan_state"),
            F.lit(True).alias("in_repayment"),
            F.lit(True).alias("latest_in_repayment"),
            F.col("la_cancel_comment").alias("cancellation_reason"),
            F.col("oi_product_line_name").alias("product"),
            team_lead.alias("team_lead"),
            F.col("cd_country").alias("country"),
            region.alias("region"),
            F.col("p_payment_date").alias("payment_date"),
            F.col("p_amount_paid").alias("amount_paid"),
        )
        .agg(
            F.sum("expected_day").alias("expected_all_mtd"),
            F.sum("expected_day_in_repayment").alias("expected_in_month_in_repayment"),
        )
        .select(*KEYS, *MEASURES)
    )


def benchmark_days(tables: Tables, windows) -> DataFrame:
    """Daily benchmarks (``d_``) of some days, with the rate in units."""
    days = pick(
        tables["benchmark_days"].where(within_any(F.col("benchmark_date"), windows)),
        "d",
        "benchmark_date",
        "customer_id",
        "loan_state",
        "daily_rate",
        "days_elapsed",
        "loan_id",
    )
    return days.withColumn("d_daily_rate", units(F.col("d_daily_rate"))).withColumnRenamed(
        "d_daily_rate", "d_rate"
    )


def with_benchmark_context(days: DataFrame, tables: Tables, periods: Sequence[Period]) -> DataFrame:
    """Add last month's report, customer, manager, account and item to daily benchmarks."""
    windows = _lookbacks(periods)
    last_month = next(p for p in periods if p.name == LAST_MONTH)
    reports = pick(
        tables["benchmark_finance_monthly"].where(
            F.col("report_date").isin(*month_ends_before(windows))
        ),
        "l",
        "loan_id",
        "report_date",
        "loan_contract_end_date",
    )
    customers = tables["customers"].select(
        F.col("customer_id").alias("cd_customer_id"),
        F.col("country").alias("cd_country"),
        F.col("assigned_to_contractor_id").alias("cd_agent_id"),
        F.col("area1").alias("cd_area1"),
        F.col("area2").alias("cd_area2"),
    )
    managers = pick(
        tables["agent_managers"].where(within_any(F.col("benchmark_date"), windows)),
        "ph",
        "sales_agent_id",
        "benchmark_date",
        "manager_name",
    )
    accounts = pick(
        tables["loan_accounts"].where(F.col("source") == ACCOUNT_SOURCE["benchmark"]),
        "la",
        "loan_account_id",
        "customer_id",
        "sales_case_id",
        "cancel_comment",
    )
    items = pick(
        tables["order_items"],
        "oi",
        "loan_account_id",
        "sales_case_id",
        "product_line_name",
        "loan_duration",
        "down_payment_days",
    )
    sold = accounts.join(
        items,
        (F.col("la_sales_case_id") == F.col("oi_sales_case_id"))
        & (F.col("la_loan_account_id") == F.col("oi_loan_account_id")),
        "left",
    )
    sold = _items_with_hub_region(sold, tables, "la_located", "oi_sales_case_id")

    rows = join_prior_month_end(
        days, reports, ("d_loan_id", "l_loan_id"), "d_benchmark_date", "l_report_date"
    )
    return lookup(
        rows.join(customers, F.col("d_customer_id") == F.col("cd_customer_id"), "left"),
        managers,
        on=[("cd_agent_id", "ph_sales_agent_id"), ("d_benchmark_date", "ph_benchmark_date")],
        spread_by=["d_loan_id", "d_benchmark_date"],
    ).join(
        sold,
        (F.col("d_loan_id") == F.col("la_loan_account_id"))
        & (F.col("d_customer_id") == F.col("la_customer_id"))
        & (within(F.col("d_benchmark_date"), last_month.days) == F.col("la_located")),
        "left",
    )


def benchmark_arm(
    tables: Tables, periods: Sequence[Period], paid: DataFrame, country: Country = UGANDA
) -> DataFrame:
    """Benchmark system: actual day, else the newest day carried forward."""
    by_area = area_region(F.col("cd_country"), F.col("cd_area1"), F.col("cd_area2"))
    in_country = tables["customers"].where(F.col("country") == country.code)
    # The newest row of the country's loans first: its customer is all it has met by then. What
    # describes it is joined to that one row, and may repeat it, so it is reduced once more.
    newest = latest_per_period(
        keep_listed(
            benchmark_days(tables, _lookbacks(periods)), "d_customer_id", in_country, "customer_id"
        ),
        periods,
        day="d_benchmark_date",
        loan="d_loan_id",
    )
    described = with_benchmark_context(newest, tables, periods).where(
        F.col("cd_country") == country.code
    )
    carried = newest_row(
        described.select(
            "period",
            F.col("d_loan_id").alias("loan_id"),
            "d_benchmark_date",
            F.col("d_customer_id").alias("ll_customer_id"),
            F.col("d_loan_state").alias("ll_loan_state"),
            F.col("d_rate").alias("ll_rate"),
            F.col("d_days_elapsed").alias("ll_days_elapsed"),
            F.col("l_loan_contract_end_date").alias("ll_loan_contract_end_date"),
            F.col("oi_product_line_name").alias("ll_product"),
            F.col("ph_manager_name").alias("ll_team_lead"),
            F.col("cd_country").alias("ll_country"),
            by_area.alias("ll_region"),
        ),
        ["period", "loan_id"],
        [F.col("d_benchmark_date")],
    )
    actual = with_benchmark_context(benchmark_days(tables, _days_of(periods)), tables, periods)
    rows = _over_calendar(
        carried.drop("d_benchmark_date"), actual, paid, periods, F.col("d_loan_id").isNotNull()
    )

    # Last month alone shows a Ugandan loan under its hub's region.
    region = (
        F.when(F.col("cd_country").isin("MZ", "CI"), F.col("cd_area2"))
        .when(
            (F.col("period") == LAST_MONTH) & (F.col("cd_country") == "UG"), F.col("loc_region")
        )
        .otherwise(F.col("cd_area1"))
    )
    rate = actual_or_carried("d_rate", "ll_rate")
    length, intro = F.col("oi_loan_duration"), F.col("oi_down_payment_days")
    grouped = (
        rows.withColumn(
            "due_all",
            rate_while_due(
                actual_or_carried("d_days_elapsed", "ll_days_elapsed"), length, intro, rate
            ),
        )
        .withColumn(
            "due_actual",
            rate_while_due(F.col("d_days_elapsed"), length, intro, F.col("d_rate")),
        )
        .groupBy(
            F.lit(PAID_COMPANY["benchmark"]).alias("company"),
            "period",
            "report_date",
            F.col("report_date").alias("generated_date"),
            F.col("l_loan_contract_end_date").alias("loan_contract_end_date"),
            F.col("ll_loan_contract_end_date").alias("new_loan_contract_end"),
            F.col("d_benchmark_date").alias("benchmark_date"),
            # A carried day has no loan id here, so equal carried rows become one.
            F.col("d_loan_id").alias("loan_id"),
            F.col("d_customer_id").alias("customer_id"),
            rate.alias("daily_rate"),
            F.col("d_loan_state").alias("loan_state"),
            F.col("ll_loan_state").alias("new_loan_state"),
            F.lit(True).alias("in_repayment"),
            F.lit(True).alias("latest_in_repayment"),
            F.col("la_cancel_comment").alias("cancellation_reason"),
            actual_or_carried("oi_product_line_name", "ll_product").alias("product"),
            actual_or_carried("ph_manager_name", "ll_team_lead").alias("team_lead"),
            actual_or_carried("cd_country", "ll_country").alias("country"),
            F.coalesce(region, F.col("ll_region")).alias("region"),
            F.col("p_payment_date").alias("payment_date"),
            F.col("p_amount_paid").alias("amount_paid"),
        )
        .agg(F.sum("due_all").alias("due_all"), F.sum("due_actual").alias("due_actual"))
    )
    return grouped.select(
        *KEYS,
        expected_by_contract(
            F.col("new_loan_contract_end"),
            F.coalesce("benchmark_date", "report_date"),
            F.col("daily_rate"),
            F.coalesce("loan_state", "new_loan_state") == "repayment",
            F.col("due_all"),
        ).alias("expected_all_mtd"),
        F.when(F.col("loan_state") == "repayment", F.col("due_actual"))
        .otherwise(F.lit(0.0))
        .alias("expected_in_month_in_repayment"),
    )


def paid_vs_expected(
    tables: Tables,
    as_of: date,
    country: Country = UGANDA,
    payments_follow_calendar: bool = False,
) -> DataFrame:
    """Loan, day and period (and payment) with what was paid and what was expected.

    ``as_of`` is the day the report is run; the periods end the day before.
    """
    periods = reporting_periods(as_of, payments_follow_calendar)
    paid = daily_payments(tables, periods, country)
    rows = (
        metered_arm(tables, periods, paid, country)
        .unionByName(snapshot_arm(tables, periods, paid, country))
        .unionByName(benchmark_arm(tables, periods, paid, country))
    )
    return with_month_end_rate(rows, tables["fx_rates"])
