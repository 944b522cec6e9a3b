"""Profile of every loan of the three systems, with its first payment."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.masking import masked
from loanbook.functions.labels import (
    ACCOUNT_SOURCE,
    CREDIT,
    LOAN_CATEGORY,
    PAYGO,
    PROFILE_COMPANY,
)
from loanbook.functions.money import amount, units
from loanbook.functions.rules import age_in_years, hub_location, overdue_days, plan_label
from loanbook.operators.payer import payment_sources
from loanbook.operators.places import with_area_manager, with_stock_point, zone_by_country
from loanbook.operators.relational import (
    lookup,
    nested,
    newest_row,
    pick,
    stack_by_position,
    without_copies,
)

Tables = Mapping[str, DataFrame]

# Fixed values
HANDOVER_SINCE = date(2018, 1, 1)
DAYS_PER_PERIOD = 30

PAYER = [
    "user_phone",
    "user_secondary_phone",
    "alternate_phone",
    "alternate_contacts",
    "sender_phone",
    "sender_id",
    "sender_name",
    "sender_fenixdb_user",
    "associate_name",
    "associate_phone",
]
PERSONAL = [
    "customer_name",
    "primary_phone_number",
    "secondary_phone_number",
    "associator_name",
    "associator_manager_name",
    "sender_name",
    "sender_phone",
    "user_phone",
    "user_secondary_phone",
    "alternate_phone",
    "alternate_contacts",
    "associate_name",
    "associate_phone",
]


def _first_payment_columns() -> list[Column]:
    """Due dates and missed flags, under both names the report gives them."""
    return [
        F.col("mf_first_payment_due").alias("first_payment_due"),
        F.col("mf_first_payment_due").alias("daily_first_payment_due_date"),
        F.col("mf_first_payment_due_monthly").alias("monthly_first_payment_due_date"),
        F.col("mf_first_payment_due_w_grace").alias("first_payment_due_w_grace"),
        F.col("mf_first_payment_due_monthly_w_grace").alias("first_payment_due_monthly_w_grace"),
        F.col("mf_missed_first_payment").alias("late_dummy"),
        F.col("mf_missed_first_payment").alias("late_dummy_daily"),
        F.col("mf_missed_first_payment_monthly").alias("late_dummy_monthly"),
        F.col("mf_days_issued_sale_date").alias("days_issued_day_0"),
    ]


def _first_payments(tables: Tables) -> DataFrame:
    return pick(
        tables["first_payments"],
        "mf",
        "account_id",
        "customer_id",
        "loan_id",
        "first_payment_due",
        "first_payment_due_monthly",
        "first_payment_due_w_grace",
        "first_payment_due_monthly_w_grace",
        "missed_first_payment",
        "missed_first_payment_monthly",
        "days_issued_sale_date",
    )


def _with_product(df: DataFrame, tables: Tables, product: Column, key: str) -> DataFrame:
    """Add ``products``, the entries of the product's type in an array, in whose place it travels."""
    entries = pick(
        tables["product_mapping"], "pm", "product_type", "product_group_name", "wattage"
    )
    return lookup(
        df.withColumn("_product", product),
        nested(entries, ["pm_product_type"], "products"),
        on=[("_product", "pm_product_type")],
        spread_by=[key],
    ).drop("_product", "pm_product_type")


def _product_columns() -> Column:
    """Group and system size of each entry of ``products``, to be spread by ``_finished``."""
    described = F.transform(
        "products",
        lambda p: F.struct(
            p.pm_product_group_name.alias("product_group_name"),
            F.concat(p.pm_wattage.cast("string"), F.lit("W")).alias("system_size"),
        ),
    )
    return F.array_distinct(described).alias("_products")


def _finished(profiles: DataFrame) -> DataFrame:
    """Equal rows once, and then one for each different entry of their product's type.

    The entries follow from the product, which every profile shows: rows that are equal but for
    them have the same, so they are compared once and not once for each entry.
    """
    once = without_copies(profiles, implied=["_products"])
    spread = once.withColumn("_product", F.explode_outer("_products"))
    entry = [F.col(f"_product.{c}").alias(c) for c in ("product_group_name", "system_size")]
    columns: list[Column] = []
    for c in profiles.columns:
        columns += entry if c == "_products" else [F.col(c)]
    return spread.select(*columns)


def _with_location(df: DataFrame, tables: Tables, location: Column, key: str) -> DataFrame:
    places = pick(tables["locations"], "loc", "location", "region")
    return lookup(
        df.withColumn("_location", location),
        places,
        on=[("_location", "loc_location")],
        spread_by=[key],
    ).drop("_location")


def metered_profiles(tables: Tables) -> DataFrame:
    """Metered accounts with their first sale, person and payer."""
    accounts = pick(
        tables["metered_accounts"],
        "ac",
        "account_id",
        "customer_id",
        "country",
        "account_start_date",
        "account_days_locked",
        "account_percent_locked",
        "account_days_til_lockout",
        "account_max_consecutive_days_locked",
        "account_state",
    )
    sold = tables["metered_sales"].where(
        (F.col("sales_order_count") == 1) & ~F.col("country_of_sale").contains("Senegal")
    )
    sales = sold.select(*[F.col(c).alias(f"sd_{c}") for c in sold.columns])
    homes = pick(
        tables["person_demographics"],
        "pd",
        "person_id",
        "region",
        "subcounty",
        "district",
        "parish",
        "occupation",
        "gender",
        "age",
        "primary_language",
        "messaging_language",
    )
    people = pick(
        tables["persons"],
        "ps",
        "person_id",
        "first_name",
        "last_name",
        "primary_phone",
        "secondary_phones",
        "alternate_contacts",
    )
    loans = pick(
        tables["metered_loans"],
        "ln",
        "account_id",
        "loan_id",
        "cancellation_date_utc",
        "payoff_date_utc",
        "prepaid_days_remaining",
        "cancellation_reason",
        "amount_remaining_interest_accrued_to_date",
        "amount_remaining_all_interest",
        "paid_principal",
        "paid_interest",
        "amount_expected",
    )
    rows = sales.join(homes, F.col("sd_customer_id") == F.col("pd_person_id"), "left").join(
        people, F.col("sd_customer_id_fenixdb") == F.col("ps_person_id"), "left"
    )
    rows = _with_product(rows, tables, F.col("sd_product_type"), "sd_account_id")
    rows = _with_location(
        rows, tables, F.coalesce("sd_sale_location", "sd_associator_location"), "sd_account_id"
    )
    rows = (
        accounts.join(rows, F.col("ac_account_id") == F.col("sd_account_id"))
        .join(_first_payments(tables), F.col("ac_account_id") == F.col("mf_account_id"), "left")
        .join(
            loans,
            (F.col("ac_account_id") == F.col("ln_account_id"))
            & (F.col("sd_loan_id") == F.col("ln_loan_id")),
            "left",
        )
        .join(payment_sources(tables), F.col("ac_account_id") == F.col("sender_customer"), "left")
    )
    payer = [
        F.col("ps_alternate_contacts").alias(c) if c == "alternate_contacts" else F.col(c)
        for c in PAYER
    ]
    profiles = rows.select(
        F.lit(PAYGO).alias("loan_type"),
        F.col("ac_account_id").alias("account_id"),
        F.col("ac_customer_id").alias("customer_id"),
        F.col("ac_country").alias("country"),
        F.to_date("ac_account_start_date").alias("account_start_date"),
        F.col("ac_account_days_locked").alias("account_days_locked"),
        F.col("ac_account_percent_locked").alias("account_percent_locked"),
        F.col("ac_account_days_til_lockout").alias("account_days_til_lockout"),
        F.col("ac_account_max_consecutive_days_locked").alias(
            "account_max_consecutive_days_locked"
        ),
        F.col("ac_account_state").alias("account_state"),
        *_first_payment_columns(),
        F.col("sd_associator_location").alias("associator_location"),
        F.col("sd_sale_location").alias("sale_location"),
        F.col("sd_product_category").alias("product_category"),
        F.col("sd_product_type").alias("product_type"),
        F.col("sd_payment_plan").alias("payment_plan"),
        _product_columns(),
        amount(F.col("sd_deposit_amount")).alias("deposit_amount"),
        F.col("sd_loan_duration").alias("loan_duration"),
        amount(F.col("sd_daily_rate")).alias("daily_rate"),
        F.concat("sd_associator_id", F.lit("f")).alias("associator_id"),
        F.col("sd_associator_role").alias("associator_role"),
        F.col("sd_associator_name").alias("associator_name"),
        F.concat("sd_associator_manager_id", F.lit("f")).alias("associator_manager_id"),
        F.col("sd_associator_manager_name").alias("associator_manager_name"),
        F.col("sd_manager_role").alias("manager_role"),
        F.col("pd_region").alias("zone"),
        F.when(F.col("sd_country_of_sale") == "Uganda", F.col("loc_region"))
        .otherwise(F.col("pd_region"))
        .alias("region"),
        F.col("pd_subcounty").alias("subcounty"),
        F.col("pd_district").alias("district"),
        F.col("pd_parish").alias("parish"),
        F.col("pd_occupation").alias("occupation"),
        F.col("pd_gender").alias("gender"),
        F.col("pd_age").alias("age"),
        F.concat("ps_first_name", F.lit(" "), "ps_last_name").alias("customer_name"),
        F.col("ps_primary_phone").alias("primary_phone_number"),
        F.col("ps_secondary_phones").alias("secondary_phone_number"),
        F.col("pd_primary_language").alias("primary_language"),
        F.col("pd_messaging_language").alias("messaging_language"),
        F.col("sd_sales_order_count").alias("sales_order_count"),
        F.col("sd_introductory_period").alias("introductory_period"),
        # both sides are whole numbers, so the quotient is one too
        F.floor(F.col("sd_loan_duration") / DAYS_PER_PERIOD).cast("int").alias("installment_periods"),
        amount(F.col("sd_daily_rate") * DAYS_PER_PERIOD).alias("initial_installment"),
        F.to_date("ln_cancellation_date_utc").alias("cancellation_date_utc"),
        F.to_date("ln_payoff_date_utc").alias("payoff_date_utc"),
        F.lit(0).alias("coop_loan"),
        overdue_days(F.col("ln_prepaid_days_remaining")).alias("par_days"),
        F.lit(PROFILE_COMPANY["metered"]).alias("company"),
        F.col("ln_cancellation_reason").alias("cancellation_reason"),
        amount(F.col("ln_amount_remaining_interest_accrued_to_date")).alias(
            "amount_remaining_interest_accrued_to_date"
        ),
        amount(F.col("ln_amount_remaining_all_interest")).alias("amount_remaining_all_interest"),
        amount(F.col("sd_total_interest")).alias("total_interest"),
        amount(F.col("sd_total_principal")).alias("total_principal"),
        amount(F.col("ln_paid_principal") + F.col("ln_paid_interest")).alias("amount_paid"),
        amount(F.col("ln_amount_expected")).alias("expected_amount"),
        *payer,
    )
    return _finished(profiles)


ACCOUNT_COLUMNS = [
    "loan_account_id",
    "customer_id",
    "source",
    "loan_type",
    "state",
    "sales_case_id",
    "handover_at_utc",
    "days_locked",
    "percent_locked",
    "days_til_lockout",
    "installment_periods",
    "initial_installment",
    "defaulted_at_utc",
    "canceled_at_utc",
    "rescheduled_at_utc",
    "paid_off_at_utc",
    "par_days",
    "cancel_comment",
    "amount_remaining",
    "loan_amount",
    "amount_paid_minus_down_payment",
    "amount_expected_minus_down_payment",
    "remaining_principal",
    "remaining_interest_accrued",
    "remaining_interest_total",
    "expected_interest",
    "expected_principal",
]


def best_loan_per_customer(tables: Tables) -> DataFrame:
    """One account per customer: the credit item with the highest down payment."""
    items = tables["order_items"].where(
        (F.col("master_loan_item") == 1) & (F.col("account_type") == CREDIT)
    ).select(F.col("loan_account_id").alias("item_loan_id"), F.col("down_payment"))
    accounts = tables["loan_accounts"].select(*ACCOUNT_COLUMNS)
    offered = accounts.join(items, F.col("loan_account_id") == F.col("item_loan_id"))
    best = newest_row(
        offered.drop("item_loan_id"),
        ["customer_id"],
        [F.col("down_payment"), F.col("loan_account_id")],
    )
    return best.select(*ACCOUNT_COLUMNS)


def _account_profiles(
    tables: Tables,
    accounts: DataFrame,
    as_of: date,
    case_of_item: bool,
    require_installment: bool,
    customer_id: str,
) -> DataFrame:
    """Joins shared by the snapshot and benchmark systems.

    ``customer_id`` is the one of two equal columns that the profile shows: the last join lays
    rows out by it, and there copies are looked for.
    """
    recent = accounts.where(F.to_date("handover_at_utc") >= F.lit(HANDOVER_SINCE))
    loans = pick(recent, "la", *ACCOUNT_COLUMNS)
    items = tables["order_items"].where(
        (F.col("fenix_product_category") == LOAN_CATEGORY)
        & (F.col("product_line_segment_name") == LOAN_CATEGORY)
        & (F.col("master_loan_item") == 1)
        & (F.col("sales_case_rank") == 1)
        & (F.col("account_type") == CREDIT)
    )
    if require_installment:
        items = items.where(
            (F.col("installment_amount") > 0)
            & (F.col("product_name").isNull() | ~F.col("product_name").contains("COVID"))
        )
    items = pick(
        items,
        "oi",
        "loan_account_id",
        "sales_case_id",
        "fenix_product_category",
        "product_name",
        "payment_plan",
        "down_payment",
        "down_payment_days",
        "loan_duration",
        "daily_rate",
        "sales_case_rank",
        "total_interest",
        "principal_price",
    )
    items = _with_product(items, tables, F.trim("oi_product_name"), "oi_loan_account_id")

    cases = pick(tables["sales_cases"], "sc", "sales_case_id", "hub_name")
    cases = _with_location(cases, tables, hub_location(F.col("sc_hub_name")), "sc_sales_case_id")

    customers = tables["customers"].where(F.col("country").isNotNull())
    customers = customers.select(*[F.col(c).alias(f"cd_{c}") for c in customers.columns])
    customers = with_area_manager(customers, tables, "cd_area2", "cd_customer_id")
    customers = with_stock_point(customers, tables, "cd_hub_id", "cd_customer_id")
    names = pick(tables["country_names"], "cn", "iso_2_abbreviation", "name")
    customers = lookup(
        customers, names, on=[("cd_country", "cn_iso_2_abbreviation")], spread_by=["cd_customer_id"]
    )
    mapped = pick(
        tables["agent_mapping"],
        "am2",
        "sales_agent_id",
        "sales_agent",
        "coordinator_id",
        "coordinator_name",
        "region",
    )
    customers = lookup(
        customers,
        mapped,
        on=[("cd_application_by_contractor_id", "am2_sales_agent_id")],
        spread_by=["cd_customer_id"],
    )
    contacts = pick(
        tables["customer_contacts"],
        "cs",
        "customer_id",
        "birthdate",
        "customer_name",
        "primary_phone_number",
        "other_phone_numbers",
    )
    customers = customers.join(
        contacts, F.col("cd_customer_id") == F.col("cs_customer_id"), "left"
    )

    case_id = F.col("oi_sales_case_id" if case_of_item else "la_sales_case_id")
    return (
        loans.join(items, F.col("la_loan_account_id") == F.col("oi_loan_account_id"))
        .join(cases, case_id == F.col("sc_sales_case_id"), "left")
        .join(
            _first_payments(tables),
            (F.col("la_loan_account_id") == F.col("mf_loan_id"))
            & (F.col("la_customer_id") == F.col("mf_customer_id")),
        )
        .join(customers, F.col(customer_id) == F.col("cd_customer_id"))
    )


def _account_columns(
    as_of: date,
    *,
    account_id: str,
    customer_id: str,
    state: Column,
    place_and_agent: list[Column],
    parish: Column,
    par_days: Column,
    company: str,
    remaining: list[Column],
    totals: list[Column],
    expected_amount: Column,
) -> list[Column]:
    country = F.col("cd_country")
    zone = zone_by_country(country, F.col("cd_area1"))
    region = F.when(country == "RW", F.coalesce("am2_region", "cd_area1")).otherwise(zone)
    subcounty = (
        F.when(country == "TZ", F.col("sc_hub_name"))
        .when(country == "KE", F.col("sp_subcounty"))
        .otherwise(F.col("cd_area3"))
    )
    ended = F.coalesce("la_defaulted_at_utc", "la_canceled_at_utc", "la_rescheduled_at_utc")
    location, agent = place_and_agent[0], place_and_agent[1:]
    return [
        F.col("la_loan_type").alias("loan_type"),
        F.col(account_id).alias("account_id"),
        F.col(customer_id).alias("customer_id"),
        F.col("cn_name").alias("country"),
        F.to_date("la_handover_at_utc").alias("account_start_date"),
        F.col("la_days_locked").alias("account_days_locked"),
        F.col("la_percent_locked").alias("account_percent_locked"),
        F.col("la_days_til_lockout").alias("account_days_til_lockout"),
        F.col("la_days_locked").alias("account_max_consecutive_days_locked"),
        state.alias("account_state"),
        *_first_payment_columns(),
        location.alias("associator_location"),
        F.col("sc_hub_name").alias("sale_location"),
        F.col("oi_fenix_product_category").alias("product_category"),
        F.col("oi_product_name").alias("product_type"),
        plan_label(
            F.col("oi_product_name"), F.col("oi_down_payment"), F.col("oi_payment_plan")
        ).alias("payment_plan"),
        _product_columns(),
        units(F.col("oi_down_payment")).alias("deposit_amount"),
        F.col("oi_loan_duration").alias("loan_duration"),
        units(F.col("oi_daily_rate")).alias("daily_rate"),
        *agent,
        zone.alias("zone"),
        region.alias("region"),
        subcounty.alias("subcounty"),
        F.col("cd_area2").alias("district"),
        parish.alias("parish"),
        F.col("cd_occupation").alias("occupation"),
        F.col("cd_gender").alias("gender"),
        age_in_years(F.col("cs_birthdate"), as_of).alias("age"),
        F.col("cs_customer_name").alias("customer_name"),
        F.col("cs_primary_phone_number").alias("primary_phone_number"),
        F.col("cs_other_phone_numbers").alias("secondary_phone_number"),
        F.col("cd_spoken_language").alias("primary_language"),
        F.col("cd_reading_language").alias("messaging_language"),
        F.col("oi_sales_case_rank").alias("sales_order_count"),
        F.col("oi_down_payment_days").alias("introductory_period"),
        F.col("la_installment_periods").alias("installment_periods"),
        units(F.col("la_initial_installment")).alias("initial_installment"),
        F.to_date(ended).alias("cancellation_date_utc"),
        F.to_date("la_paid_off_at_utc").alias("payoff_date_utc"),
        F.when(F.col("oi_product_name").startswith("Cooperative"), 1)
        .otherwise(0)
        .alias("coop_loan"),
        par_days.alias("par_days"),
        F.lit(company).alias("company"),
        F.col("la_cancel_comment").alias("cancellation_reason"),
        remaining[0].alias("amount_remaining_interest_accrued_to_date"),
        remaining[1].alias("amount_remaining_all_interest"),
        totals[0].alias("total_interest"),
        totals[1].alias("total_principal"),
        units(F.col("la_amount_paid_minus_down_payment")).alias("amount_paid"),
        expected_amount.alias("expected_amount"),
        *[F.lit(None).cast("string").alias(c) for c in PAYER],
    ]


def snapshot_profiles(tables: Tables, as_of: date) -> DataFrame:
    """Snapshot system: one loan per customer; Rwanda names its agents in a mapping."""
    accounts = best_loan_per_customer(tables).where(F.col("source") == ACCOUNT_SOURCE["snapshot"])
    rows = _account_profiles(
        tables,
        accounts,
        as_of,
        case_of_item=True,
        require_installment=True,
        customer_id="la_customer_id",
    )
    rwanda, tanzania = F.col("cd_country") == "RW", F.col("cd_country") == "TZ"

    def mapped_or_own(mapped: str, own: str) -> Column:
        return F.when(rwanda, F.coalesce(mapped, own)).otherwise(F.col(own))

    remaining = units(F.col("la_amount_remaining"))
    columns = _account_columns(
        as_of,
        account_id="la_customer_id",
        customer_id="la_customer_id",
        state=F.col("la_state"),
        place_and_agent=[
            F.when(rwanda, F.col("am2_region")).otherwise(F.col("cd_area1")),
            mapped_or_own("am2_sales_agent_id", "cd_application_by_contractor_id").alias(
                "associator_id"
            ),
            F.col("cd_application_by_contractor_role").alias("associator_role"),
            mapped_or_own("am2_sales_agent", "cd_application_by_contractor_name").alias(
                "associator_name"
            ),
            mapped_or_own("am2_coordinator_id", "cd_application_coordinator_id").alias(
                "associator_manager_id"
            ),
            F.when(tanzania, F.col("am_manager"))
            .otherwise(mapped_or_own("am2_coordinator_name", "cd_application_coordinator_name"))
            .alias("associator_manager_name"),
            F.col("cd_application_coordinator_role").alias("manager_role"),
        ],
        parish=F.lit(None).cast("string"),
        par_days=F.col("la_par_days"),
        company=PROFILE_COMPANY["snapshot"],
        remaining=[remaining, remaining],
        totals=[F.lit(0.0), units(F.col("la_loan_amount") - F.col("oi_down_payment"))],
        expected_amount=units(F.col("la_amount_expected_minus_down_payment")),
    )
    return _finished(rows.select(*columns))


def benchmark_profiles(tables: Tables, as_of: date) -> DataFrame:
    """Benchmark system: every loan. The manager's name repeats the seller's."""
    accounts = tables["loan_accounts"].where(F.col("source") == ACCOUNT_SOURCE["benchmark"]).select(*ACCOUNT_COLUMNS)
    rows = _account_profiles(
        tables,
        accounts,
        as_of,
        case_of_item=False,
        require_installment=False,
        customer_id="mf_customer_id",
    )

    def both(first: str, second: str) -> Column:
        return units(F.col(first)) + units(F.col(second))

    columns = _account_columns(
        as_of,
        account_id="mf_account_id",
        customer_id="mf_customer_id",
        state=F.lower("la_state"),
        place_and_agent=[
            F.col("cd_area1"),
            F.col("cd_application_by_contractor_id").alias("associator_id"),
            F.col("cd_application_by_contractor_role").alias("associator_role"),
            F.col("cd_application_by_contractor_name").alias("associator_name"),
            F.col("cd_application_coordinator_id").alias("associator_manager_id"),
            F.col("cd_application_by_contractor_name").alias("associator_manager_name"),
            F.col("cd_application_coordinator_role").alias("manager_role"),
        ],
        parish=F.col("cd_area4"),
        par_days=overdue_days(F.col("la_days_til_lockout")),
        company=PROFILE_COMPANY["benchmark"],
        remaining=[
            both("la_remaining_principal", "la_remaining_interest_accrued"),
            both("la_remaining_principal", "la_remaining_interest_total"),
        ],
        totals=[units(F.col("oi_total_interest")), units(F.col("oi_principal_price"))],
        expected_amount=both("la_expected_interest", "la_expected_principal"),
    )
    return _finished(rows.select(*columns))


def first_payment_profile(tables: Tables, as_of: date, mask_key: str | None = None) -> DataFrame:
    """Loan (and payer) in 74 columns, no row twice.

    Each system's rows carry its own company, so no row of one can equal a row of
    another, and duplicates are removed per system. ``mask_key`` replaces names
    and phones by hashes under that key.
    """
    rows = stack_by_position(
        [metered_profiles(tables), snapshot_profiles(tables, as_of), benchmark_profiles(tables, as_of)]
    )
    return masked(rows, PERSONAL, mask_key)
