"""Repayment behaviour: the usual payment of each loan and month, and its rhythm.

The usual amount of a loan and month is chosen before the dimensions are joined,
so those joins see one row per loan and month instead of one per payment.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanbook.functions.masking import masked
from loanbook.functions.labels import ARREARS, PAYGO
from loanbook.functions.money import units
from loanbook.functions.rules import (
    LoanTerms,
    expected_month_to_date,
    expected_ongoing_month_to_date,
    light_days,
    product_segment,
    rhythm,
    with_terms,
)
from loanbook.operators.relational import (
    first_row,
    left_join_nested,
    lookup,
    nested,
    pick,
    stack_by_position,
)
from loanbook.operators.usual import (
    BENCHMARK,
    METERED,
    SNAPSHOT,
    STATISTICS,
    own_items,
    payments_of_month,
    usual_amounts,
)

Tables = Mapping[str, DataFrame]

# Fixed value: payments after this local date are looked at.
SINCE = date(2023, 12, 31)
ZAMBIA = "ZM"

DESCRIBING = [
    "loan_type",
    "loan_id",
    "months_since_loan_start",
    "customer_id",
    "customer_name",
    "primary_phone_number",
    "other_phone_numbers",
    "region",
    "district",
    "parish",
    "direction",
    "assigned_to_agent_id",
    "assigned_to_agent_name",
    "product",
    "product_segmentation",
    "paid_mtd",
    "expected_ongoing_mtd",
    "expected_mtd",
    "month_end",
    "trans_amount",
    "daily_rate",
    "lighting_days_paid_for",
]


def customer_profiles(tables: Tables) -> DataFrame:
    """Customers with contact, place and the agent who looks after them."""
    customers = pick(
        tables["customers"],
        "cd",
        "customer_id",
        "country",
        "adopted_by_contractor_id",
        "application_by_contractor_id",
        "application_by_contractor_name",
        "assigned_to_contractor_id",
        "assigned_to_contractor_name",
    )
    agents = pick(tables["contractors"], "oc", "contractor_id", "name", "surname")
    contacts = pick(
        tables["customer_contacts"],
        "cs",
        "customer_id",
        "customer_name",
        "primary_phone_number",
        "other_phone_numbers",
        "address",
        "directions",
        "location_area_id",
    )
    areas = pick(
        tables["location_areas"], "ar", "location_area_id", "area1", "area2", "area3", "area4"
    )
    joined = lookup(
        customers.join(
            contacts, F.col("cd_customer_id") == F.col("cs_customer_id"), "left"
        ),
        areas,
        on=[("cs_location_area_id", "ar_location_area_id")],
        spread_by=["cd_customer_id"],
    )
    joined = lookup(
        joined,
        agents,
        on=[("cd_adopted_by_contractor_id", "oc_contractor_id")],
        spread_by=["cd_customer_id"],
    )
    full_name = F.concat("oc_name", F.lit(" "), "oc_surname")
    return joined.select(
        F.col("cd_customer_id").alias("customer_id"),
        F.col("cd_country").alias("customer_country"),
        F.col("cs_customer_name").alias("customer_name"),
        F.col("cs_primary_phone_number").alias("primary_phone_number"),
        F.coalesce("cs_other_phone_numbers", F.lit("")).alias("other_phone_numbers"),
        "ar_area1",
        "ar_area2",
        F.coalesce("ar_area3", "ar_area4").alias("ar_parish"),
        F.concat("cs_address", F.lit(","), "cs_directions").alias("written_direction"),
        F.coalesce(
            "cd_adopted_by_contractor_id",
            "cd_application_by_contractor_id",
            "cd_assigned_to_contractor_id",
        ).alias("assigned_to_agent_id"),
        F.coalesce(
            full_name, "cd_application_by_contractor_name", "cd_assigned_to_contractor_name"
        ).alias("assigned_to_agent_name"),
    )


PRODUCT = ["pm_product_group_name", "pm_wattage"]


def _products(tables: Tables) -> DataFrame:
    """One row per product type with its entries in an array, which travels in their place."""
    products = pick(
        tables["product_mapping"], "pm", "product_type", "product_group_name", "wattage"
    )
    return nested(products, ["pm_product_type"], "products")


def _or_blank(*columns: str) -> Column:
    return F.coalesce(*columns, F.lit(""))


def _text_or_null(column: str) -> Column:
    return F.col(column).cast("string")


def _finance_profiles(tables: Tables, table: str, *extra: str) -> DataFrame:
    """Per loan: daily finance figures, its ``products``, and the customer's profile."""
    finance = pick(
        tables[table],
        "f",
        "loan_id",
        "customer_id",
        "product_type",
        "daily_rate",
        "paid_in_month",
        "expected_in_month_ongoing",
        "expected_in_month_total",
        *extra,
    )
    finance = lookup(
        finance,
        _products(tables),
        on=[("f_product_type", "pm_product_type")],
        spread_by=["f_loan_id"],
    )
    return finance.join(
        customer_profiles(tables), F.col("f_customer_id") == F.col("customer_id"), "left"
    )


MONTHLY = [
    "months_since_loan_start",
    "paid_in_month",
    "expected_in_month_ongoing",
    "expected_in_month_total",
]


def _with_month_report(df: DataFrame, tables: Tables, table: str, since: date) -> DataFrame:
    reports = pick(
        tables[table].where(F.col("report_date") > F.lit(since)),
        "lm",
        "loan_id",
        "report_date",
        *MONTHLY,
    )
    # A loan's reports lie beside it, so its rows are not moved again to meet them by month.
    joined = df.join(
        nested(reports, ["lm_loan_id"], "reports"), F.col("loan_id") == F.col("lm_loan_id"), "left"
    )
    return left_join_nested(
        joined,
        "reports",
        [f"lm_{column}" for column in MONTHLY],
        lambda report: report.lm_report_date == F.col("month_end"),
    )


def _reported(column: str) -> Column:
    return F.coalesce(f"lm_{column}", f"f_{column}").cast("double")


def _one_per_month(df: DataFrame, frequency: Column) -> DataFrame:
    """One row per loan and month, from rows that carry ``times``.

    Equal rows are counted together; of different ones (a dimension that lists a
    loan twice) the more frequent stays, then the smaller. One sort, which spills, brings equal
    rows and those of a month together; a grouping would keep hash tables of whole rows.
    """
    keys = ["loan_id", "month_end"]
    rest = [c for c in [*DESCRIBING, "statistics"] if c not in keys]
    alike = Window.partitionBy(*keys, F.xxhash64(*rest), *rest)
    counted = df.withColumn("frequency", frequency.over(alike)).drop("times")
    best = first_row(counted, keys, [-F.col("frequency")])
    loans = F.when(F.col("loan_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return best.withColumn("count_loans", loans).select(
        *DESCRIBING, "count_loans", "frequency", "statistics"
    )


def usual_metered(
    tables: Tables, months: DataFrame, country: str = ZAMBIA, since: date = SINCE
) -> DataFrame:
    profiles = _finance_profiles(tables, "metered_finance_daily", "customer_id_fenixdb")
    persons = pick(tables["persons"], "ps", "person_id", "landmark")
    homes = pick(tables["person_demographics"], "pd", "person_id", "region", "district", "parish")
    profiles = profiles.join(
        persons, F.col("f_customer_id_fenixdb") == F.col("ps_person_id"), "left"
    ).join(homes, F.col("f_customer_id_fenixdb") == F.col("pd_person_id"), "left")
    rows = usual_amounts(months, METERED).join(
        profiles, F.col("loan_id") == F.col("f_loan_id"), "left"
    )
    rows = _with_month_report(rows, tables, "metered_finance_monthly", since)
    rows = left_join_nested(rows, "products", PRODUCT)
    rate = F.col("f_daily_rate").cast("double")
    rows = rows.select(
        F.lit(PAYGO).alias("loan_type"),
        "loan_id",
        F.coalesce(_text_or_null("lm_months_since_loan_start"), F.lit("")).alias(
            "months_since_loan_start"
        ),
        "customer_id",
        "customer_name",
        "primary_phone_number",
        _or_blank("other_phone_numbers").alias("other_phone_numbers"),
        _or_blank("pd_region", "ar_area1").alias("region"),
        _or_blank("pd_district", "ar_area2").alias("district"),
        _or_blank("pd_parish", "ar_parish").alias("parish"),
        _or_blank("ps_landmark", "written_direction").alias("direction"),
        "assigned_to_agent_id",
        "assigned_to_agent_name",
        F.col("pm_product_group_name").alias("product"),
        product_segment(F.col("pm_wattage"), F.col("f_product_type")).alias("product_segmentation"),
        _reported("paid_in_month").alias("paid_mtd"),
        _reported("expected_in_month_ongoing").alias("expected_ongoing_mtd"),
        _reported("expected_in_month_total").alias("expected_mtd"),
        "month_end",
        "trans_amount",
        rate.alias("daily_rate"),
        light_days(F.col("trans_amount"), rate).alias("lighting_days_paid_for"),
        "times",
        "statistics",
    )
    return _one_per_month(rows, F.sum("times"))


def usual_benchmark(
    tables: Tables, months: DataFrame, country: str = ZAMBIA, since: date = SINCE
) -> DataFrame:
    profiles = _finance_profiles(tables, "benchmark_finance_daily")
    rows = usual_amounts(months, BENCHMARK).join(
        profiles, F.col("loan_id") == F.col("f_loan_id"), "left"
    )
    rows = _with_month_report(rows, tables, "benchmark_finance_monthly", since)
    rows = left_join_nested(rows, "products", PRODUCT)
    rate = F.col("f_daily_rate").cast("double")
    rows = rows.select(
        F.lit(PAYGO).alias("loan_type"),
        "loan_id",
        _text_or_null("lm_months_since_loan_start").alias("months_since_loan_start"),
        "customer_id",
        "customer_name",
        "primary_phone_number",
        _or_blank("other_phone_numbers").alias("other_phone_numbers"),
        _or_blank("ar_area1").alias("region"),
        _or_blank("ar_area2").alias("district"),
        _or_blank("ar_parish").alias("parish"),
        _or_blank("written_direction").alias("direction"),
        "assigned_to_agent_id",
        "assigned_to_agent_name",
        F.col("pm_product_group_name").alias("product"),
        product_segment(F.col("pm_wattage"), F.col("f_product_type")).alias("product_segmentation"),
        _reported("paid_in_month").alias("paid_mtd"),
        _reported("expected_in_month_ongoing").alias("expected_ongoing_mtd"),
        _reported("expected_in_month_total").alias("expected_mtd"),
        "month_end",
        "trans_amount",
        rate.alias("daily_rate"),
        light_days(F.col("trans_amount"), rate).alias("lighting_days_paid_for"),
        "times",
        "statistics",
    )
    # Different transactions are counted, so a repeated profile does not add to them.
    return _one_per_month(rows, F.max("times"))


# Columns that tell who somebody is or where they live.
PERSONAL = [
    "customer_name",
    "primary_phone_number",
    "other_phone_numbers",
    "direction",
    "assigned_to_agent_name",
]


def booking_schedule(tables: Tables, country: str) -> DataFrame:
    """Loans with their own items and the ``products`` of their type."""
    return lookup(
        own_items(tables, country).withColumn("_product", F.trim("oi_product_name")),
        _products(tables),
        on=[("_product", "pm_product_type")],
        spread_by=["la_loan_account_id"],
    ).drop("_product")


def join_snapshots(df: DataFrame, tables: Tables, since: date) -> DataFrame:
    """Snapshot of the month end (``d_``) and that of its previous month (``m_``).

    The second is on the date the first itself names, since a month may be missing. A loan's
    snapshots of these days, a few dozen at most, lie beside it in an array that both are found
    in: they move once, and the loan's rows need no other layout for either.
    """
    columns = ["snapshot_at", "state", "months_on_book", "terminated_at", "outstanding_amount"]
    ends = [*columns, "customer_id", "snapshot_prev_month"]

    def at_end(day: Column) -> Column:
        return (day > F.lit(since)) & (day == F.last_day(day))

    days = tables["snapshot_days"]
    # Only month ends and the days that some of these name: a few dozen dates, so the history
    # in between is neither shuffled nor, where it is partitioned by date, read.
    named = (
        days.where(at_end(F.col("snapshot_at")))
        .select(F.col("snapshot_prev_month").alias("named_day"))
        .distinct()
    )
    wanted = days.join(
        F.broadcast(named), F.col("snapshot_at") == F.col("named_day"), "left"
    ).where(at_end(F.col("snapshot_at")) | F.col("named_day").isNotNull())
    snapshots = nested(
        wanted.select(F.col("loan_account_id").alias("sn_loan_account_id"), *ends),
        ["sn_loan_account_id"],
        "snapshots",
    )
    rows = df.join(snapshots, F.col("loan_id") == F.col("sn_loan_account_id"), "left")
    rows = rows.withColumn(
        "_end",
        F.explode_outer(
            F.filter(
                "snapshots",
                lambda s: (s.snapshot_at == F.col("month_end")) & at_end(s.snapshot_at),
            )
        ),
    ).withColumn(
        "_before",
        F.explode_outer(
            F.filter("snapshots", lambda s: s.snapshot_at == F.col("_end.snapshot_prev_month"))
        ),
    )
    return rows.select(
        *df.columns,
        *[F.col(f"_end.{c}").alias(f"d_{c}") for c in ends],
        *[F.col(f"_before.{c}").alias(f"m_{c}") for c in columns],
    )


def snapshot_terms() -> LoanTerms:
    """Terms of a booking's loan, previous month's snapshot first, then this month's."""

    def earlier(column: str) -> Column:
        return F.coalesce(f"m_{column}", f"d_{column}")

    return LoanTerms(
        country=F.col("customer_country"),
        loan_type=F.col("la_loan_type"),
        state=earlier("state"),
        snapshot=earlier("snapshot_at"),
        handover=F.col("la_handover_at_utc"),
        months_on_book=earlier("months_on_book"),
        terminated_at=earlier("terminated_at"),
        item_daily_rate=F.col("la_daily_rate"),
        initial_installment=F.col("la_initial_installment"),
        period_days=F.col("la_installment_period_days"),
        periods=F.col("la_installment_periods"),
        loan_duration=F.col("la_loan_duration"),
        down_payment_days=F.col("oi_down_payment_days"),
    )


def usual_bookings(
    tables: Tables,
    months: DataFrame,
    country: str = ZAMBIA,
    since: date = SINCE,
    fix_admin_order: bool = False,
) -> DataFrame:
    """Snapshot system. The two expected amounts stand in swapped places, as in the
    report this follows; ``fix_admin_order`` puts them under their own names."""
    rows = usual_amounts(months, SNAPSHOT, inner=True).join(
        booking_schedule(tables, country), F.col("loan_id") == F.col("la_loan_account_id")
    )
    rows = join_snapshots(rows, tables, since).join(
        customer_profiles(tables), F.col("d_customer_id") == F.col("customer_id"), "left"
    )
    # The sort of ``_one_per_month`` and the last grouping of all systems need no other layout.
    rows = rows.repartition("loan_id")
    rows, terms = with_terms(rows, snapshot_terms())
    rows = rows.withColumn("loan_rate", units(F.col("la_daily_rate")))
    rate = F.col("loan_rate")
    expected = expected_month_to_date(terms, rate)
    ongoing = expected_ongoing_month_to_date(terms, rate)
    first, second = (ongoing, expected) if fix_admin_order else (expected, ongoing)
    rows = left_join_nested(rows, "products", PRODUCT)
    rows = rows.select(
        F.lit(ARREARS).alias("loan_type"),
        "loan_id",
        _text_or_null("m_months_on_book").alias("months_since_loan_start"),
        "customer_id",
        "customer_name",
        "primary_phone_number",
        _or_blank("other_phone_numbers").alias("other_phone_numbers"),
        _or_blank("ar_area1").alias("region"),
        _or_blank("ar_area2").alias("district"),
        _or_blank("ar_parish").alias("parish"),
        _or_blank("written_direction").alias("direction"),
        "assigned_to_agent_id",
        "assigned_to_agent_name",
        F.col("pm_product_group_name").alias("product"),
        product_segment(F.col("pm_wattage"), F.col("oi_product_name")).alias(
            "product_segmentation"
        ),
        (units(F.col("m_outstanding_amount")) - units(F.col("d_outstanding_amount"))).alias(
            "paid_mtd"
        ),
        first.alias("expected_ongoing_mtd"),
        second.alias("expected_mtd"),
        "month_end",
        "trans_amount",
        F.round(rate, 0).alias("daily_rate"),
        light_days(F.col("trans_amount"), rate).alias("lighting_days_paid_for"),
        "times",
        "statistics",
    )
    return _one_per_month(rows, F.sum("times"))


def _usual_with_statistics(
    tables: Tables, country: str, since: date, fix_admin_order: bool, admin_naive_local: bool
) -> DataFrame:
    """Usual amount per loan and month of the three systems, equal rows once, with ``statistics``.

    The three arms begin from the same rows, so the payments below them are read once. Rows are
    laid out by loan, as in each arm, so that removing duplicates and the last grouping share one
    shuffle, in which a task's rows stay together.
    """
    months = payments_of_month(tables, country, since, admin_naive_local)
    stacked = stack_by_position(
        [
            usual_metered(tables, months, country, since),
            usual_benchmark(tables, months, country, since),
            usual_bookings(tables, months, country, since, fix_admin_order),
        ]
    )
    return stacked.repartition("loan_id").distinct()


def usual_payments(
    tables: Tables,
    country: str = ZAMBIA,
    since: date = SINCE,
    fix_admin_order: bool = False,
    admin_naive_local: bool = False,
) -> DataFrame:
    """Usual amount per loan and month of the three systems, equal rows once."""
    rows = _usual_with_statistics(tables, country, since, fix_admin_order, admin_naive_local)
    return rows.drop("statistics")


def repayment_behaviour(
    tables: Tables,
    country: str = ZAMBIA,
    since: date = SINCE,
    fix_admin_order: bool = False,
    admin_naive_local: bool = False,
    mask_key: str | None = None,
) -> DataFrame:
    """Loan and month: usual amount, light days, rhythm, statistics, paid and expected.

    ``mask_key`` replaces the customer's and the agent's names, phones and the way to the
    house by hashes under that key.
    """
    usual = _usual_with_statistics(tables, country, since, fix_admin_order, admin_naive_local)
    joined = usual.withColumn("found", F.explode_outer("statistics")).select(
        "*", *[F.col(f"found.{name}").alias(name) for name in STATISTICS]
    )
    keys = [
        "loan_id",
        "loan_type",
        "months_since_loan_start",
        "customer_id",
        "customer_name",
        "primary_phone_number",
        "other_phone_numbers",
        "region",
        "district",
        "parish",
        "direction",
        "assigned_to_agent_id",
        "assigned_to_agent_name",
        "product",
        "product_segmentation",
        F.round("daily_rate", 0).alias("daily_rate"),
        "lighting_days_paid_for",
        rhythm(F.col("lighting_days_paid_for")).alias("frequency_lighting_type"),
        "month_end",
        "frequency",
        F.col("trans_amount").alias("median_amount"),
        "total_transactions",
        "max_payment",
        "min_payment",
        "avg_payment",
    ]
    rows = joined.groupBy(*keys).agg(
        F.sum("count_loans").alias("nb_loans"),
        F.sum("paid_mtd").alias("paid_mtd"),
        F.sum("expected_ongoing_mtd").alias("expected_ongoing_mtd"),
        F.sum("expected_mtd").alias("expected_mtd"),
    )
    return masked(rows, PERSONAL, mask_key)
