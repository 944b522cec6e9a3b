"""Column helpers shared by the operators: words, repeated rows, the package for the tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.session import shared_folder, written  # noqa: F401

#: White space between words; a word is a longest run of anything else.
SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; of no text, an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def one_row_each(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as ``copies`` says, without that column."""
    kept = [c for c in df.columns if c != copies]
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(copies)
    return df.select(*kept, times).select(*kept)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the tasks, unless their Python finds it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if root in map(os.path.abspath, found) or any(f.endswith("/loanbook.zip") for f in context.listFiles):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "loanbook.zip")
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in os.walk(os.path.join(root, "loanbook")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, root))
    context.addPyFile(target)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run within hand Python so many rows at a time: for rows of whole sets or blocks,
    of which the usual 10,000 fill a worker's memory. Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
