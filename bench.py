"""Time the five reports at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The loan tables are derived from the given ones and stored as Parquet first (timed apart, as
``stage_tables``), since a user's reports read stored tables. They go to $BENCH_STAGE_DIR,
any URI that all executors can write and read; a local temporary folder is the default, for
local mode only. Every report then runs twice: ``cold`` and ``queries`` have the whole time,
``build`` the part of the second run that builds the DataFrame.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanbook import (  # noqa: E402
    benchmark_reconciliation,
    first_payment_profile,
    orphan_loans_by_month,
    paid_vs_expected,
    repayment_behaviour,
)
from loanbook.session import local_session  # noqa: E402
from loanbook.sources import load_parquet  # noqa: E402
from workload.queries import listed_loans  # noqa: E402
from workload.staging import AS_OF, TABLES, StagedTables  # noqa: E402

REPORTS = {
    "paid_vs_expected": lambda t: paid_vs_expected(t, AS_OF),
    "repayment_behaviour": repayment_behaviour,
    "first_payment_profile": lambda t: first_payment_profile(t, AS_OF),
    "orphan_loans_by_month": lambda t: orphan_loans_by_month(t, AS_OF),
    "benchmark_reconciliation": lambda t: benchmark_reconciliation(t, listed_loans(t)),
}


def since(start: float) -> float:
    return round(time.perf_counter() - start, 3)


def timed(report, tables) -> tuple[float, float]:
    """Seconds to build the report's DataFrame, and to build and run it."""
    start = time.perf_counter()
    rows = report(tables)
    built = since(start)
    rows.write.format("noop").mode("overwrite").save()
    return built, since(start)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    staged = StagedTables(spark, sf_dir)
    stored = os.environ.get("BENCH_STAGE_DIR") or tempfile.mkdtemp(prefix="run-")
    start = time.perf_counter()
    for name in TABLES:
        staged[name].write.mode("overwrite").parquet(f"{stored}/{name}.parquet")
    stage = since(start)
    tables = load_parquet(spark, stored)
    cold = {name: timed(report, tables)[1] for name, report in REPORTS.items()}
    warm = {name: timed(report, tables) for name, report in REPORTS.items()}
    print(
        json.dumps(
            {
                "metric": "five_reports_warm_total",
                "value": round(sum(whole for _, whole in warm.values()), 3),
                "unit": "sec",
                "queries": {name: whole for name, (_, whole) in warm.items()},
                "build": {name: built for name, (built, _) in warm.items()},
                "cold": cold,
                "stage_tables": stage,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": os.environ.get("BENCH_CPUS", "8"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
