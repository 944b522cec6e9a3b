"""Month-end exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanbook.functions.rules import country_name
from loanbook.operators.relational import lookup, pick


def with_month_end_rate(df: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Add ``eom_rate_usd`` by the month end of ``report_date`` and the country's name."""
    rates = pick(fx_rates, "fx", "month", "country", "end_of_month_rate")
    joined = lookup(
        df,
        rates,
        on=[
            (F.last_day("report_date"), "fx_month"),
            (country_name(F.col("country")), "fx_country"),
        ],
        spread_by=["loan_id", "report_date", "product", "team_lead", "region"],
    )
    return joined.withColumnRenamed("fx_end_of_month_rate", "eom_rate_usd").drop(
        "fx_month", "fx_country"
    )
