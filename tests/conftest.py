import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from pyspark.sql import types as T  # noqa: E402

from loanbook.session import local_session  # noqa: E402
from loanbook.sources import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", partitions=4, memory="6g")


class Book(dict):
    """Loan tables from a few rows; columns not given are NULL, tables not given empty."""

    def __init__(self, spark, **rows):
        super().__init__()
        self._spark, self._rows = spark, rows

    def __missing__(self, name):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        data = [tuple(row.get(f.name) for f in schema.fields) for row in self._rows.get(name, [])]
        unknown = {k for row in self._rows.get(name, []) for k in row} - set(schema.fieldNames())
        assert not unknown, unknown
        self[name] = self._spark.createDataFrame(data, schema)
        return self[name]


@pytest.fixture
def book(spark):
    return lambda **rows: Book(spark, **rows)
