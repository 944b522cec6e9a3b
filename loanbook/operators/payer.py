"""Who pays: one row per sender, with the payer's and the seller's contacts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from loanbook.functions.rules import international_phone
from loanbook.operators.relational import first_row, lookup, pick

Tables = Mapping[str, DataFrame]

# Account transaction types that are deposits or payments.
PAYING_TYPES = (2, 4)


def senders(tables: Tables) -> DataFrame:
    """First paying account and payment per sender's phone.

    All payments of one phone tie in the later choice of one row per person, so
    the transactions are reduced to one row per phone before any person is joined.
    """
    transactions = tables["metered_account_transactions"].where(
        F.col("transaction_type_id").isin(*PAYING_TYPES) & F.col("payment_id").isNotNull()
    )
    sent = pick(tables["payments"], "fp", "id", "sender")
    paid = transactions.join(sent, F.col("payment_id") == F.col("fp_id"), "left").select(
        international_phone(F.col("fp_sender")).alias("sender_phone"), "account_id", "payment_id"
    )
    return first_row(paid, ["sender_phone"], [F.col("account_id"), F.col("payment_id")])


def associators(tables: Tables) -> DataFrame:
    """Account with the seller of its first sale and the seller's phone."""
    sales = pick(
        tables["metered_sales"].where(F.col("sales_order_count") == 1),
        "ds",
        "account_id",
        "associator_id",
        "associator_name",
    )
    phones = pick(tables["persons"], "dp", "person_id", "primary_phone")
    return sales.join(phones, F.col("ds_associator_id") == F.col("dp_person_id"), "left").select(
        F.col("ds_account_id").alias("dd_account_id"),
        F.col("ds_associator_name").alias("associate_name"),
        F.col("dp_primary_phone").alias("associate_phone"),
    )


def payment_sources(tables: Tables) -> DataFrame:
    """One row per sending person: the earliest sale's, ties by account and payment.

    Senders that match no person share one NULL person and so one row.
    """
    people = pick(
        tables["persons"],
        "sp",
        "person_id",
        "primary_phone",
        "first_name",
        "last_name",
        "fenixdb_user_id",
    )
    first_sales = tables["metered_sales"].where(F.col("sales_order_count") == 1).groupBy(
        F.col("customer_id").alias("fs_person_id")
    ).agg(F.min(F.to_date("start_date_utc")).alias("first_sale_on"))
    known = senders(tables).join(people, F.col("sender_phone") == F.col("sp_primary_phone"), "left")
    # Senders that match no person have no id: many rows without a key.
    matched = lookup(
        known, first_sales, on=[("sp_person_id", "fs_person_id")], spread_by=["sender_phone"]
    )
    order = [F.col("first_sale_on"), F.col("account_id"), F.col("payment_id")]
    one = first_row(matched, ["sp_person_id"], order)

    accounts = pick(tables["metered_accounts"], "ma", "account_id", "user_id")
    owners = pick(
        tables["persons"],
        "cp",
        "person_id",
        "primary_phone",
        "secondary_phones",
        "alternate_contacts",
    )
    rows = (
        one.join(accounts, F.col("account_id") == F.col("ma_account_id"), "left")
        .join(owners, F.col("ma_user_id") == F.col("cp_person_id"), "left")
        .join(associators(tables), F.col("account_id") == F.col("dd_account_id"), "left")
        .select(
            F.col("cp_primary_phone").alias("user_phone"),
            F.col("cp_secondary_phones").alias("user_secondary_phone"),
            F.col("cp_alternate_contacts").alias("alternate_phone"),
            "sender_phone",
            F.col("sp_person_id").alias("sender_id"),
            F.concat("sp_first_name", F.lit(" "), "sp_last_name").alias("sender_name"),
            F.col("sp_fenixdb_user_id").alias("sender_fenixdb_user"),
            F.col("account_id").alias("sender_customer"),
            "associate_name",
            "associate_phone",
        )
    )
    # an account may list several owners or sellers; still one row per sender
    return first_row(rows, ["sender_id"], [F.col("sender_customer")])
