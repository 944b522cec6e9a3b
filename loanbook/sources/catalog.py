"""Input tables: logical names, declared columns, and how to load them.

Three loan systems feed the reports. In this package they are called

* ``metered``   - accounts metered by a device, with loan metrics per day;
* ``snapshot``  - accounts snapshotted per day and per month, payments as bookings;
* ``benchmark`` - loans with performance benchmarks per day.

Money of the snapshot and benchmark systems is in cents, money of the metered
system in units. Timestamps are UTC: either ``timestamp_ntz``, or ``timestamp``
in a session whose time zone is UTC.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

# Declared columns per logical table, as DDL.
SCHEMAS: dict[str, str] = {
    # benchmark system
    "benchmark_days": (
        "loan_id string, customer_id string, loan_state string, benchmark_date date, "
        "daily_rate decimal(18,2), days_elapsed int"
    ),
    "benchmark_transactions": (
        "id string, loan_id string, customer_id string, transaction_type string, "
        "added_at_utc timestamp, portion_interest decimal(18,2), portion_principal decimal(18,2)"
    ),
    "benchmark_finance_daily": (
        "loan_id string, customer_id string, product_type string, daily_rate decimal(18,2), "
        "paid_in_month decimal(18,2), expected_in_month_ongoing decimal(18,2), "
        "expected_in_month_total decimal(18,2)"
    ),
    "benchmark_finance_monthly": (
        "loan_id string, account_id string, customer_id string, report_date date, "
        "loan_state string, loan_contract_end_date date, months_since_loan_start int, "
        "days_elapsed int, paid_in_month decimal(18,2), expected_in_month_ongoing decimal(18,2), "
        "expected_in_month_total decimal(18,2), benchmark_date date, "
        "loan_cancelled_at_utc timestamp, loan_completed_at_utc timestamp, "
        "percent_locked double, par_days int"
    ),
    "benchmark_finance_calculations": (
        "loan_id string, account_id string, report_date date, remaining_all decimal(18,2), "
        "remaining_net_unfin decimal(18,2), accounts_receivable_all decimal(18,2), "
        "accounts_receivable_net_unfin decimal(18,2)"
    ),
    # snapshot system
    "snapshot_days": (
        "loan_account_id string, customer_id string, snapshot_at date, snapshot_prev_month date, "
        "state string, months_on_book int, terminated_at timestamp, "
        "outstanding_amount decimal(18,2)"
    ),
    "snapshot_months": (
        "loan_account_id string, customer_id string, snapshot_at date, state string, "
        "months_on_book int"
    ),
    "payment_bookings": (
        "payment_booking_id string, loan_account_id string, customer_id string, amount decimal(18,2), "
        "transaction_type string, payment_at timestamp, transaction_at timestamp"
    ),
    # metered system
    "metered_accounts": (
        "account_id string, user_id string, customer_id string, country string, "
        "account_start_date date, account_days_locked int, account_percent_locked double, "
        "account_days_til_lockout int, account_max_consecutive_days_locked int, "
        "account_state string"
    ),
    "metered_account_transactions": (
        "account_id string, payment_id string, transaction_type_id int"
    ),
    "metered_cancellations": (
        "loan_id string, cancellation_reason string, change_recorded_at_utc timestamp"
    ),
    "metered_days": (
        "loan_id string, account_id string, customer_id string, benchmark_date date, "
        "daily_rate decimal(18,2), in_repayment boolean, days_elapsed int"
    ),
    "metered_finance_daily": (
        "loan_id string, customer_id string, customer_id_fenixdb string, product_type string, "
        "daily_rate decimal(18,2), paid_in_month decimal(18,2), "
        "expected_in_month_ongoing decimal(18,2), expected_in_month_total decimal(18,2)"
    ),
    "metered_finance_monthly": (
        "loan_id string, account_id string, customer_id string, report_date date, "
        "loan_contract_end_date date, loan_state string, months_since_loan_start int, "
        "days_elapsed int, active string, paid_in_month decimal(18,2), "
        "expected_in_month_ongoing decimal(18,2), expected_in_month_total decimal(18,2)"
    ),
    "metered_loans": (
        "loan_id string, account_id string, loan_state string, cancellation_date_utc timestamp, "
        "payoff_date_utc timestamp, prepaid_days_remaining int, cancellation_reason string, "
        "amount_remaining_interest_accrued_to_date decimal(18,2), "
        "amount_remaining_all_interest decimal(18,2), paid_principal decimal(18,2), "
        "paid_interest decimal(18,2), amount_expected decimal(18,2)"
    ),
    "metered_sales": (
        "loan_id string, account_id string, customer_id string, customer_id_fenixdb string, "
        "sales_order_count int, start_date_utc timestamp, date_fulfilled_utc timestamp, "
        "associator_id string, associator_name string, associator_role string, "
        "associator_location string, associator_manager_id string, "
        "associator_manager_name string, manager_role string, sale_location string, "
        "product_category string, product_type string, payment_plan string, "
        "deposit_amount decimal(18,2), loan_duration int, daily_rate decimal(18,2), "
        "country_of_sale string, introductory_period int, total_interest decimal(18,2), "
        "total_principal decimal(18,2), fulfillment_source string"
    ),
    "metered_transactions": (
        "id string, loan_id string, customer_id string, country string, transaction_type string, "
        "transaction_type_id int, added_at_utc timestamp, portion_interest decimal(18,2), "
        "portion_principal decimal(18,2)"
    ),
    "payments": "id string, sender string",
    "person_demographics": (
        "person_id string, region string, subcounty string, district string, parish string, "
        "occupation string, gender string, age int, primary_language string, "
        "messaging_language string"
    ),
    "persons": (
        "person_id string, primary_phone string, secondary_phones string, "
        "alternate_contacts string, first_name string, last_name string, fenixdb_user_id string, "
        "landmark string"
    ),
    # shared by the snapshot and benchmark systems
    "contractor_links": (
        "powerhub_entry_id string, powerhub_entry_type string, fenixdb_entry_id string, "
        "inserted_at_utc timestamp"
    ),
    "contractors": "contractor_id string, name string, surname string",
    "customers": (
        "customer_id string, country string, area1 string, area2 string, area3 string, "
        "area4 string, hub_id string, occupation string, gender string, spoken_language string, "
        "reading_language string, application_by_contractor_id string, "
        "application_by_contractor_name string, application_by_contractor_role string, "
        "application_coordinator_id string, application_coordinator_name string, "
        "application_coordinator_role string, assigned_to_contractor_id string, "
        "assigned_to_contractor_name string, adopted_by_contractor_id string"
    ),
    "customer_contacts": (
        "customer_id string, customer_name string, birthdate date, primary_phone_number string, "
        "other_phone_numbers string, address string, directions string, location_area_id string"
    ),
    "loan_accounts": (
        "loan_account_id string, customer_id string, source string, loan_type string, "
        "state string, state_detailed string, sales_case_id string, handover_at_utc timestamp, "
        "days_locked int, percent_locked double, days_til_lockout int, installment_periods int, "
        "installment_period_days int, initial_installment decimal(18,2), "
        "initial_amount decimal(18,2), daily_rate decimal(18,2), loan_duration int, "
        "loan_contract_end_date date, last_benchmark_date date, defaulted_at_utc timestamp, "
        "canceled_at_utc timestamp, rescheduled_at_utc timestamp, paid_off_at_utc timestamp, "
        "par_days int, cancel_comment string, amount_remaining decimal(18,2), "
        "loan_amount decimal(18,2), amount_paid_minus_down_payment decimal(18,2), "
        "amount_expected_minus_down_payment decimal(18,2), remaining_principal decimal(18,2), "
        "remaining_interest_accrued decimal(18,2), remaining_interest_total decimal(18,2), "
        "expected_interest decimal(18,2), expected_principal decimal(18,2), migrated_loan int, "
        "risk_category string, days_prepaid_remaining int, inserted_at_utc timestamp"
    ),
    "order_items": (
        "sales_order_item_id string, sales_case_id string, loan_account_id string, "
        "customer_id string, loan_portfolio_id string, account_type string, sale_type string, "
        "master_loan_item int, sales_case_rank int, country string, handover_at_utc timestamp, "
        "fenix_product_category string, product_line_segment_name string, "
        "product_line_name string, product_name string, payment_plan string, "
        "down_payment decimal(18,2), down_payment_days int, loan_duration int, "
        "daily_rate decimal(18,2), installment_amount decimal(18,2), "
        "total_interest decimal(18,2), principal_price decimal(18,2), "
        "sales_order_submitted_by_type string, sales_order_submitted_by_name string"
    ),
    "reassigned_customers": (
        "customer_id string, to_contractor_id string, to_contractor_name string, "
        "to_contractor_role_name string, created_at_utc timestamp"
    ),
    "reschedule_requests": "resultant_loan_account_id string",
    "sales_cases": "sales_case_id string, hub_name string, finalized int",
    # dimensions and analyst inputs
    "agent_managers": "sales_agent_id string, benchmark_date date, manager_name string",
    "agent_mapping": (
        "sales_agent_id string, sales_agent string, coordinator_id string, "
        "coordinator_name string, region string"
    ),
    "channel_mapping": (
        "order_item_id string, account_id string, loan_id string, source string, "
        "sales_agent_name string"
    ),
    "countries": "iso_2_abbreviation string, iso_3_abbreviation string, name string",
    "country_names": "iso_2_abbreviation string, name string",
    "country_timezones": "iso_2_abbreviation string, default_timezone string",
    "first_payments": (
        "account_id string, customer_id string, loan_id string, first_payment_due date, "
        "first_payment_due_monthly date, first_payment_due_w_grace date, "
        "first_payment_due_monthly_w_grace date, missed_first_payment int, "
        "missed_first_payment_monthly int, days_issued_sale_date int"
    ),
    "fx_rates": "month date, country string, end_of_month_rate double",
    "location_areas": (
        "location_area_id string, country string, area0 string, area1 string, area2 string, "
        "area3 string, area4 string"
    ),
    "locations": "location string, region string",
    "portfolio_owners": "loan_id string, person_responsible string",
    "product_mapping": "product_type string, product_group_name string, wattage int",
    # dimensions in place of two lookup functions of the warehouse
    "area_manager": "area2 string, manager string, region string",
    "hub_stock_point": "hub_id string, region string, subcounty string",
}

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns of table ``name``, cast to the declared types.

    A zoned timestamp needs a session in UTC. Booleans kept as text ('TRUE'/'FALSE') become booleans here. A naive
    timestamp is kept as it is, so a filter on it still reaches the scan.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    want = T.StructType.fromDDL(SCHEMAS[name]).fields
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    missing = [field.name for field in want if field.name not in have]
    if missing:
        raise ValueError(f"table {name!r} lacks column(s): {', '.join(missing)}")

    def column(field: T.StructField) -> str:
        found = have[field.name]
        if isinstance(found, T.TimestampType) and zone not in UTC_NAMES:
            raise ValueError(
                f"{name}.{field.name} is a zoned timestamp and the session's time zone is {zone}; "
                "days would move. Set spark.sql.session.timeZone to UTC."
            )
        naive = isinstance(field.dataType, T.TimestampType) and isinstance(found, T.TimestampNTZType)
        if found == field.dataType or naive:
            return f"`{field.name}`"
        return f"CAST(`{field.name}` AS {field.dataType.simpleString()}) AS `{field.name}`"

    return df.selectExpr(*[column(field) for field in want])


def load_parquet(
    spark: SparkSession, root: str, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Tables stored as ``<root>/<logical name>.parquet`` (file or partitioned folder)."""
    return {
        name: conform(spark.read.parquet(f"{root}/{name}.parquet"), name)
        for name in (names or SCHEMAS)
    }


def load_warehouse(
    spark: SparkSession, located: Mapping[str, str], names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Tables of the session catalog; ``located`` maps logical names to the caller's tables."""
    wanted = list(names or SCHEMAS)
    missing = [name for name in wanted if name not in located]
    if missing:
        raise ValueError(f"no table given for: {', '.join(missing)}")
    return {name: conform(spark.table(located[name]), name) for name in wanted}
