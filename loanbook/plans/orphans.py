"""Loans and customers per month with and without a recently active agent.

Whatever depends on the loan, the item or the customer is joined at that grain
first; the monthly history, the large side, then meets few prepared tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanbook.functions.labels import CHANNEL_SOURCE, ORPHAN_SOURCE, PAYGO
from loanbook.functions.rules import has_owner, months_on_book, orphan_status
from loanbook.operators.agents import reassigned_since, sales_span_by_id, sales_span_by_name
from loanbook.operators.relational import lookup, pick, stack_by_position

Tables = Mapping[str, DataFrame]

# States of a snapshot that still count, and the window of the report.
SNAPSHOT_STATES = (
    "maintained",
    "exceeded_grace_period",
    "exceeded_loan_period",
    "in_grace_period",
)
NOT_SOLD_IN = ("Senegal", "Kenya")
REPORT_DAYS = 365

KEYS = [
    "report_date",
    "source",
    "loan_type",
    "loan_state",
    "country",
    "orphaned_status",
    "months_on_book",
]


def _last_by_name(tables: Tables, prefix: str) -> DataFrame:
    return sales_span_by_name(tables).select(
        F.col("sa_name").alias(f"{prefix}_name"), F.col("last_sale").alias(f"{prefix}_last_sale")
    )


def _owners(tables: Tables) -> DataFrame:
    """Listed loans, whether an owner is named; both answers of a loan are kept."""
    owned = has_owner(F.col("loan_id").isNotNull(), F.col("person_responsible"))
    return (
        tables["portfolio_owners"]
        .select(F.col("loan_id").alias("fpa_loan_id"), F.coalesce(owned, F.lit(False)).alias("owned"))
        .distinct()
    )


def _with_owner(df: DataFrame, tables: Tables, loan: str) -> DataFrame:
    return df.join(_owners(tables), F.col(loan) == F.col("fpa_loan_id"), "left").drop("fpa_loan_id")


def _with_reassignment(
    df: DataFrame, tables: Tables, customer: str, spread_by: list[str]
) -> DataFrame:
    """Add the day the customer was first reassigned, safe for a customer with many rows."""
    return lookup(
        df, reassigned_since(tables), on=[(customer, "oc_customer_id")], spread_by=spread_by
    ).drop("oc_customer_id")


def _countries(tables: Tables) -> DataFrame:
    return pick(
        tables["countries"], "ctx", "iso_2_abbreviation", "iso_3_abbreviation", "name"
    )


def _count_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(
        F.countDistinct("loan").alias("count_loan_id"),
        F.countDistinct("customer").alias("count_customer_id"),
    )


def _recent(df: DataFrame, day: str, as_of: date) -> DataFrame:
    return df.where(F.col(day) >= F.lit(as_of - timedelta(days=REPORT_DAYS)))


def metered_orphans(tables: Tables, as_of: date) -> DataFrame:
    sales = pick(
        tables["metered_sales"].where(~F.col("country_of_sale").isin(*NOT_SOLD_IN)),
        "sd",
        "account_id",
        "loan_id",
        "associator_name",
        "country_of_sale",
    ).withColumn("sd_agent", F.lower("sd_associator_name"))
    sales = lookup(
        sales, _last_by_name(tables, "rs"), on=[("sd_agent", "rs_name")], spread_by=["sd_loan_id"]
    )
    sales = lookup(
        sales,
        _countries(tables),
        on=[("sd_country_of_sale", "ctx_name")],
        spread_by=["sd_loan_id"],
    )
    sales = _with_owner(sales, tables, "sd_loan_id")

    months = _recent(tables["metered_finance_monthly"], "report_date", as_of).where(
        F.col("active") == "active"
    )
    rows = months.join(
        sales,
        (F.col("account_id") == F.col("sd_account_id")) & (F.col("loan_id") == F.col("sd_loan_id")),
    )
    rows = _with_reassignment(rows, tables, "customer_id", ["loan_id", "report_date"])
    return _count_by_month(
        rows.select(
            "report_date",
            F.lit(ORPHAN_SOURCE["metered"]).alias("source"),
            F.lit(PAYGO).alias("loan_type"),
            F.lit("in_repayment").alias("loan_state"),
            F.col("ctx_iso_3_abbreviation").alias("country"),
            orphan_status(
                F.col("owned"),
                F.col("reassigned_at"),
                F.col("rs_last_sale"),
                F.col("report_date"),
            ).alias("orphaned_status"),
            months_on_book(F.col("days_elapsed")).alias("months_on_book"),
            F.col("loan_id").alias("loan"),
            F.col("customer_id").alias("customer"),
        )
    )


def _sold_items(tables: Tables) -> DataFrame:
    """Order items with channel agent, country, owner and reassignment (``oi_``, ``crm_``).

    The monthly rows join these on loan and customer, so what hangs on either of
    the two can be attached here.
    """
    items = pick(
        tables["order_items"],
        "oi",
        "sales_order_item_id",
        "sales_case_id",
        "loan_account_id",
        "customer_id",
        "loan_portfolio_id",
        "master_loan_item",
        "country",
        "sales_order_submitted_by_name",
    )
    channels = tables["channel_mapping"].where(F.col("source") == CHANNEL_SOURCE).select(
        F.col("order_item_id").alias("crm_item_id"),
        F.col("account_id").alias("crm_account_id"),
        F.col("loan_id").alias("crm_loan_id"),
        F.col("sales_agent_name").alias("crm_agent_name"),
    )
    items = items.join(
        channels,
        (F.col("oi_sales_order_item_id") == F.col("crm_item_id"))
        & (F.coalesce("oi_loan_portfolio_id", F.lit("")) == F.col("crm_account_id"))
        & (F.coalesce("oi_loan_account_id", F.lit("")) == F.col("crm_loan_id")),
        "left",
    ).drop("crm_item_id", "crm_account_id", "crm_loan_id")
    items = lookup(
        items,
        _countries(tables),
        on=[("oi_country", "ctx_iso_2_abbreviation")],
        spread_by=["oi_sales_order_item_id"],
    )
    items = _with_owner(items, tables, "oi_loan_account_id")
    return _with_reassignment(items, tables, "oi_customer_id", ["oi_sales_order_item_id"])


def _customers_with_agent(tables: Tables) -> DataFrame:
    """Customers with the applying agent's name and last sale by the agent's id."""
    by_id = sales_span_by_id(tables).select(
        F.col("associator_id").alias("rsd_id"), F.col("last_sale").alias("rsd_last_sale")
    )
    customers = tables["customers"].select(
        F.col("customer_id").alias("cd_customer_id"),
        F.col("application_by_contractor_id").alias("cd_agent_id"),
        F.col("application_by_contractor_name").alias("cd_agent_name"),
    )
    return lookup(
        customers, by_id, on=[("cd_agent_id", "rsd_id")], spread_by=["cd_customer_id"]
    ).drop("rsd_id")


def snapshot_orphans(tables: Tables, as_of: date) -> DataFrame:
    """Snapshot system; an account names its agent only in its last benchmark month."""
    items = _sold_items(tables).where(~F.col("ctx_iso_2_abbreviation").like("DE"))
    items = lookup(
        items.withColumn("channel_agent", F.lower("crm_agent_name")),
        _last_by_name(tables, "ch"),
        on=[("channel_agent", "ch_name")],
        spread_by=["oi_sales_order_item_id"],
    )
    agents = _customers_with_agent(tables).withColumn("applied_agent", F.lower("cd_agent_name"))
    agents = lookup(
        agents,
        _last_by_name(tables, "ap"),
        on=[("applied_agent", "ap_name")],
        spread_by=["cd_customer_id"],
    )
    accounts = pick(
        tables["loan_accounts"],
        "la",
        "loan_account_id",
        "customer_id",
        "last_benchmark_date",
        "loan_type",
    )
    accounts = accounts.join(agents, F.col("la_customer_id") == F.col("cd_customer_id"), "left")

    months = _recent(tables["snapshot_months"], "snapshot_at", as_of).where(
        F.col("state").isin(*SNAPSHOT_STATES)
    )
    rows = months.join(
        items,
        (F.col("customer_id") == F.col("oi_customer_id"))
        & (F.col("loan_account_id") == F.col("oi_loan_account_id")),
    ).join(
        accounts,
        (F.col("loan_account_id") == F.col("la_loan_account_id"))
        & (F.col("customer_id") == F.col("la_customer_id"))
        & (F.col("snapshot_at") == F.col("la_last_benchmark_date")),
        "left",
    )
    by_name = F.when(F.col("channel_agent").isNotNull(), F.col("ch_last_sale")).otherwise(
        F.col("ap_last_sale")
    )
    return _count_by_month(
        rows.select(
            F.col("snapshot_at").alias("report_date"),
            F.lit(ORPHAN_SOURCE["snapshot"]).alias("source"),
            F.col("la_loan_type").alias("loan_type"),
            F.col("state").alias("loan_state"),
            F.col("ctx_iso_3_abbreviation").alias("country"),
            orphan_status(
                F.col("owned"),
                F.col("reassigned_at"),
                F.coalesce(by_name, F.col("rsd_last_sale")),
                F.col("snapshot_at"),
            ).alias("orphaned_status"),
            F.col("months_on_book").cast("double").alias("months_on_book"),
            F.col("loan_account_id").alias("loan"),
            F.col("customer_id").alias("customer"),
        )
    )


def benchmark_orphans(tables: Tables, as_of: date) -> DataFrame:
    cases = pick(tables["sales_cases"].where(F.col("finalized") == 1), "sc", "sales_case_id")
    items = (
        _sold_items(tables)
        .where(F.col("oi_master_loan_item") == 1)
        .join(cases, F.col("oi_sales_case_id") == F.col("sc_sales_case_id"))
    )
    accounts = pick(
        tables["loan_accounts"].where(F.col("initial_amount") > 0), "la", "loan_account_id"
    )
    items = items.join(
        accounts, F.col("oi_loan_account_id") == F.col("la_loan_account_id"), "left_semi"
    )
    items = items.join(
        _customers_with_agent(tables), F.col("oi_customer_id") == F.col("cd_customer_id"), "left"
    ).withColumn(
        "agent",
        F.lower(F.coalesce("cd_agent_name", "crm_agent_name", "oi_sales_order_submitted_by_name")),
    )
    items = lookup(
        items,
        _last_by_name(tables, "rs"),
        on=[("agent", "rs_name")],
        spread_by=["oi_sales_order_item_id"],
    )

    months = _recent(tables["benchmark_finance_monthly"], "report_date", as_of).where(
        F.col("loan_state") == "active"
    )
    rows = months.join(
        items,
        (F.col("customer_id") == F.col("oi_customer_id"))
        & (F.col("loan_id") == F.col("oi_loan_account_id")),
    )
    return _count_by_month(
        rows.select(
            "report_date",
            F.lit(ORPHAN_SOURCE["benchmark"]).alias("source"),
            F.lit(PAYGO).alias("loan_type"),
            "loan_state",
            F.col("ctx_iso_3_abbreviation").alias("country"),
            orphan_status(
                F.col("owned"),
                F.col("reassigned_at"),
                F.coalesce("rs_last_sale", "rsd_last_sale"),
                F.col("report_date"),
            ).alias("orphaned_status"),
            months_on_book(F.col("days_elapsed")).alias("months_on_book"),
            F.col("loan_id").alias("loan"),
            F.col("customer_id").alias("customer"),
        )
    )


def orphan_loans_by_month(tables: Tables, as_of: date, with_share: bool = False) -> DataFrame:
    """Distinct loans and customers per month and orphan status.

    ``with_share`` adds the status's share of the loans among the rows that are
    equal in every other key.
    """
    counts = stack_by_position(
        [
            metered_orphans(tables, as_of),
            snapshot_orphans(tables, as_of),
            benchmark_orphans(tables, as_of),
        ]
    )
    return _with_share(counts) if with_share else counts


def _with_share(counts: DataFrame) -> DataFrame:
    others = [key for key in KEYS if key != "orphaned_status"]
    # at most two rows per window: the two statuses
    total: Column = F.sum("count_loan_id").over(Window.partitionBy(*others))
    return counts.withColumn("share_of_loans", F.col("count_loan_id") / total)
