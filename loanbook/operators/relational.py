"""Relational helpers: prefixed columns, one row per key, small-dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType


def pick(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """The named columns, renamed to ``<prefix>_<column>`` so joins stay unambiguous."""
    return df.selectExpr(*[f"`{c}` AS `{prefix}_{c}`" for c in columns])


def _nulls_largest(columns: Sequence[Column]) -> list[Column]:
    flagged = []
    for position, column in enumerate(columns):
        flagged += [column.isNull().alias(f"n{position}"), column.alias(f"v{position}")]
    return flagged


def _extreme(df: DataFrame, keys: Sequence[str], by: Sequence[Column], pick_row) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*_nulls_largest(by)).alias("order")
    row = F.expr(f"struct({', '.join(f'`{c}`' for c in rest)})").alias("row")
    best = df.groupBy(*keys).agg(pick_row(F.struct(order, row)).alias("best"))
    return best.select(*keys, "best.row.*")


def first_row(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Row with the smallest ``by`` per key, NULLs last, ties to the smallest row.

    An aggregate, not a ranking window: every task reduces its rows before the
    shuffle, so a key that holds a large part of the data (NULL among them) costs
    one row per task. A struct with strings makes each task sort its own rows by key;
    pass only the columns that are needed.
    """
    return _extreme(df, keys, by, F.min)


def newest_row(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Row with the largest ``by`` per key, NULLs first, ties to the largest row."""
    return _extreme(df, keys, by, F.max)


def without_copies(df: DataFrame, implied: Sequence[str] = ()) -> DataFrame:
    """The rows of ``distinct()``, for wide rows of which few repeat.

    ``implied`` names columns that are equal where all others are, so they need no comparison.

    Equal rows meet by one sort, which begins with a hash of the row and spills where memory
    is short. ``distinct`` keeps two hash tables of whole rows, one before and one after the
    shuffle, and both in one task where the rows lie by key already.
    """
    every = [F.col(f"`{c}`") for c in df.columns if c not in implied]
    alike = Window.partitionBy(F.xxhash64(*every), *every).orderBy(F.lit(0))
    return df.withColumn("_copy", F.row_number().over(alike)).where(F.col("_copy") == 1).drop("_copy")


def lookup(
    left: DataFrame,
    dimension: DataFrame,
    on: Sequence[tuple[str | Column, str]],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Left join to a dimension. ``on`` pairs a left column or expression with one of its columns.

    A plain join: adaptive execution broadcasts a dimension by its real size, and beyond the
    limit it splits a hot key's left rows. Rows without the key find nothing, yet a shuffle puts
    all of them in one partition; with ``spread_by`` a text key that is NULL is replaced by a
    hash of these columns, so such rows are dealt over all partitions whether or not splitting
    is on. Give columns that tell the left rows apart.
    """
    pairs = [(F.col(m) if isinstance(m, str) else m, F.col(theirs)) for m, theirs in on]
    condition = reduce(lambda a, b: a & b, [mine == theirs for mine, theirs in pairs])
    if not spread_by:
        return left.join(dimension, condition, "left")
    texts = [_is_text(left, mine) for mine, _ in pairs]
    dealt = F.concat(F.lit(_NO_KEY), F.xxhash64(*spread_by).cast("string"))
    # The condition on the key itself stays, so a dealt row matches nothing, not even by chance.
    condition = reduce(
        lambda a, b: a & b,
        [
            (F.coalesce(mine, dealt) == theirs) & mine.isNotNull() if text else mine == theirs
            for (mine, theirs), text in zip(pairs, texts)
        ],
    )
    return left.join(dimension, condition, "left")


#: What a replaced key begins with; no key of a table does.
_NO_KEY = "\u0000"


def _is_text(df: DataFrame, column: Column) -> bool:
    return isinstance(df.select(column).schema[0].dataType, StringType)


def nested(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per key without NULLs, with the other columns of its rows in an array.

    For tables with a few rows per key, such as a loan's items or its days of one month.
    """
    rest = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    return df.where(known).groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias(name))


def left_join_nested(
    df: DataFrame, name: str, columns: Sequence[str], matches=None
) -> DataFrame:
    """Spread an array of ``nested`` rows over those that ``matches(row)`` (all, if not given), as
    a left join does: a row without any stays, with NULLs."""
    found = F.explode_outer(F.filter(F.col(name), matches) if matches else F.col(name))
    spread = df.withColumn("_found", found)
    return spread.select(
        *[c for c in df.columns if c != name], *[F.col(f"_found.{c}").alias(c) for c in columns]
    )


def stack_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position; names come from the first frame."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.union(frame)
    return stacked


def keep_listed(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose ``column`` is among the ids: a semi join, however long the list."""
    listed = ids.select(F.col(id_column).alias("_listed_id"))
    return df.join(listed, F.col(column) == F.col("_listed_id"), "left_semi")
