"""Names and phones replaced by keyed hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keyed_hash(value: Column, key: str) -> Column:
    """SHA-256 of the key and the inner hash of key and value; NULL stays NULL.

    Without the key nobody can try all phone numbers against it.
    """
    inner = F.sha2(F.concat(F.lit(key), F.lit("\x00"), value.cast("string")), 256)
    return F.sha2(F.concat(F.lit(key), F.lit("\x01"), inner), 256)


def masked(df: DataFrame, columns: Sequence[str], key: str | None) -> DataFrame:
    """``df`` with the named columns hashed, or as it is without a key."""
    if key is None:
        return df
    if not key:
        raise ValueError("the mask needs a key that is not empty")
    return df.withColumns({c: keyed_hash(F.col(c), key) for c in columns})
