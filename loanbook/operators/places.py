"""Places: hub to region, and the two dimensions that replace lookup functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.rules import hub_location
from loanbook.operators.relational import lookup, pick


def hub_regions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Sales case, its hub name, and the region of the location the hub is named after."""
    cases = pick(tables["sales_cases"], "sc", "sales_case_id", "hub_name")
    places = pick(tables["locations"], "loc", "location", "region")
    return lookup(
        cases.withColumn("_hub_location", hub_location(F.col("sc_hub_name"))),
        places,
        on=[("_hub_location", "loc_location")],
        spread_by=["sc_sales_case_id"],
    ).drop("_hub_location", "loc_location")


def with_area_manager(df: DataFrame, tables: Mapping[str, DataFrame], area2: str, key: str):
    """Add ``am_manager`` and ``am_region`` of the second-level area."""
    managers = pick(tables["area_manager"], "am", "area2", "manager", "region")
    return lookup(df, managers, on=[(area2, "am_area2")], spread_by=[key]).drop("am_area2")


def with_stock_point(df: DataFrame, tables: Mapping[str, DataFrame], hub_id: str, key: str):
    """Add ``sp_region`` and ``sp_subcounty`` of the hub's stock point."""
    points = pick(tables["hub_stock_point"], "sp", "hub_id", "region", "subcounty")
    return lookup(df, points, on=[(hub_id, "sp_hub_id")], spread_by=[key]).drop("sp_hub_id")


def zone_by_country(country: Column, area1: Column) -> Column:
    """Zone: managed area, stock point, location or first-level area, by country."""
    return (
        F.when(country == "TZ", F.col("am_region"))
        .when(country == "KE", F.col("sp_region"))
        .when(country == "UG", F.col("loc_region"))
        .otherwise(area1)
    )
