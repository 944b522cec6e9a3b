"""Compare a Spark result with DuckDB's answer to the check SQL, values and all."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

DRIVER = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """Same text for equal values of either engine; doubles to nine digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal, int)):
        number = float(value)
        return "nan" if math.isnan(number) else f"{number + 0.0:.9g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    found = con.execute(sql)
    duck_names, duck = rows_of([c[0] for c in found.description], found.fetchall())
    names, mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != duck_names:
        return f"columns: {sorted(set(names) ^ set(duck_names))}"
    if mine == duck:
        return None
    extra, lacking = mine - duck, duck - mine
    text = [f"rows {sum(mine.values())} / {sum(duck.values())}"]
    for label, side in (("spark", extra), ("check", lacking)):
        for row in sorted(side, key=str)[:2]:
            text.append(f"{label}: {dict(zip(names, row))}")
    return "\n".join(text)
