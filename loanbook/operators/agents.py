"""Sales agents: when they sold first and last, and whom customers moved to.

First and last are taken per customer or agent before the joins, so a customer
with many items or an agent with many customers never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.labels import CREDIT
from loanbook.operators.relational import first_row, lookup

Tables = Mapping[str, DataFrame]


def _span(day: Column) -> list[Column]:
    return [F.min(day).alias("first_sale"), F.max(day).alias("last_sale")]


def _merged_span() -> list[Column]:
    return [F.min("first_sale").alias("first_sale"), F.max("last_sale").alias("last_sale")]


def _item_span(items: DataFrame) -> DataFrame:
    """First and last handover per customer."""
    return items.groupBy(F.col("customer_id").alias("item_customer_id")).agg(
        *_span(F.to_date("handover_at_utc"))
    )


def earliest_links(tables: Tables) -> DataFrame:
    """First contractor link inserted per agent entry."""
    links = tables["contractor_links"].where(F.col("powerhub_entry_type") == "Contractor")
    return first_row(
        links, ["powerhub_entry_id"], [F.col("inserted_at_utc"), F.col("fenixdb_entry_id")]
    )


def sales_span_by_name(tables: Tables) -> DataFrame:
    """First and last sale per agent name, over first sales of active loans and metered sales."""
    first_sales = tables["order_items"].where(
        (F.col("account_type") == CREDIT)
        & (F.col("sale_type") == "FIRST SALE")
        & (F.col("sales_order_submitted_by_type") != "User")
    )
    active = tables["loan_accounts"].where(F.col("state") == "active").select(
        F.col("customer_id").alias("active_customer_id")
    )
    customers = tables["customers"].select(
        F.col("customer_id").alias("cd_customer_id"),
        F.lower(
            F.coalesce("application_by_contractor_name", "assigned_to_contractor_name")
        ).alias("sa_name"),
    )
    booked = (
        _item_span(first_sales)
        .join(active, F.col("item_customer_id") == F.col("active_customer_id"), "left_semi")
        .join(customers, F.col("item_customer_id") == F.col("cd_customer_id"), "left")
        .groupBy("sa_name")
        .agg(*_merged_span())
    )
    metered = (
        tables["metered_sales"]
        .groupBy(F.lower("associator_name").alias("sa_name"))
        .agg(*_span(F.to_date("date_fulfilled_utc")))
    )
    return booked.unionByName(metered).groupBy("sa_name").agg(*_merged_span())


def sales_span_by_id(tables: Tables) -> DataFrame:
    """First and last sale per agent id, over the master items of credit sales."""
    items = tables["order_items"].where(
        (F.col("account_type") == CREDIT) & (F.col("master_loan_item") == 1)
    )
    customers = tables["customers"].select(
        F.col("customer_id").alias("cd_customer_id"),
        F.col("application_by_contractor_id").alias("associator_id"),
    )
    return (
        _item_span(items)
        .join(customers, F.col("item_customer_id") == F.col("cd_customer_id"), "left")
        .groupBy("associator_id")
        .agg(*_merged_span())
    )


def reassigned_agents(tables: Tables) -> DataFrame:
    """Customers with the agent who adopted them and that agent's first and last sale."""
    moved = tables["reassigned_customers"].select(
        F.col("customer_id").alias("oc_customer_id"),
        F.col("to_contractor_id").alias("oc_agent_id"),
        F.col("to_contractor_name").alias("oc_agent_name"),
        F.col("to_contractor_role_name").alias("oc_agent_role"),
    )
    by_name = sales_span_by_name(tables).select(
        "sa_name", F.col("first_sale").alias("first_by_name"), F.col("last_sale").alias("last_by_name")
    )
    by_id = sales_span_by_id(tables).select(
        "associator_id", F.col("first_sale").alias("first_by_id"), F.col("last_sale").alias("last_by_id")
    )
    customers = tables["customers"].select("customer_id", "adopted_by_contractor_id")
    rows = customers.join(
        moved,
        (F.col("adopted_by_contractor_id") == F.col("oc_agent_id"))
        & (F.col("customer_id") == F.col("oc_customer_id")),
        "left",
    )
    rows = lookup(
        rows, by_name, on=[(F.lower("oc_agent_name"), "sa_name")], spread_by=["customer_id"]
    )
    rows = lookup(
        rows, by_id, on=[("adopted_by_contractor_id", "associator_id")], spread_by=["customer_id"]
    )
    return (
        rows.groupBy(
            F.col("oc_agent_name").alias("reassigned_agent_name"),
            F.col("adopted_by_contractor_id").alias("reassigned_agent_id"),
            "customer_id",
            F.col("oc_agent_role").alias("reassigned_agent_role"),
        )
        .agg(
            F.min(F.coalesce("first_by_name", "first_by_id")).alias("first_sale_at"),
            F.max(F.coalesce("last_by_name", "last_by_id")).alias("last_sale_at"),
        )
    )


def reassigned_since(tables: Tables) -> DataFrame:
    """Day each customer was first reassigned.

    "Known by a date" asks only whether such a day exists by then, so the first
    one answers it, with one row per customer.
    """
    return tables["reassigned_customers"].groupBy(
        F.col("customer_id").alias("oc_customer_id")
    ).agg(F.min(F.to_date("created_at_utc")).alias("reassigned_at"))
