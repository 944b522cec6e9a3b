from loanbook.sources.catalog import SCHEMAS, conform, load_parquet, load_warehouse

__all__ = ["SCHEMAS", "conform", "load_parquet", "load_warehouse"]
