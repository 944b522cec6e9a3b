"""Plans: what is scanned, moved or broadcast, on stored tables without small-table shortcuts."""

import os
import re

import pytest
from pyspark.sql import functions as F

from loanbook.operators.payments import daily_payments
from loanbook.operators.relational import without_copies
from loanbook.operators.usual import monthly_payments, payments_of_month
from loanbook.plans.first_payments import first_payment_profile
from loanbook.plans.paid_vs_expected import benchmark_arm, metered_arm, snapshot_arm
from loanbook.plans.repayment import (
    DESCRIBING,
    SINCE,
    ZAMBIA,
    _one_per_month,
    repayment_behaviour,
    usual_benchmark,
    usual_bookings,
    usual_metered,
)
from loanbook.sources import load_parquet
from workload.queries import KEPT, PERIODS, registered
from workload.staging import AS_OF, BASE, ONE_PASS, TABLES, StagedTables, _needed, _repeating, _with_clause

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

if not os.path.isdir(SF_DIR):
    pytest.skip("no test data", allow_module_level=True)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The loan tables as a user stores them."""
    folder = tmp_path_factory.mktemp("tables")
    staged = StagedTables(spark, SF_DIR)
    for name in TABLES:
        staged[name].write.parquet(f"{folder}/{name}.parquet")
    return load_parquet(spark, str(folder))


def scans(plan: str, table: str) -> int:
    """Scans of a table; a reused exchange names none."""
    return len(re.findall(rf"FileScan parquet .*?/{table}\.parquet", plan))


@pytest.fixture
def as_at_scale(spark):
    """Plans as they are made: no side is small enough for a broadcast that is not asked for."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan()


def ways_to(node, table: str, above: tuple = ()) -> list[tuple]:
    """For every scan of a table, the nodes above it, from the result down."""
    name = node.nodeName()
    if name.startswith("Scan parquet") and f"/{table}.parquet" in node.toString():
        return [above]
    children = node.children()
    found = []
    for i in range(children.size()):
        found += ways_to(children.apply(i), table, (*above, name))
    return found


def test_repayment_reads_each_payment_table_once(as_at_scale, stored):
    plan = physical(repayment_behaviour(stored)).toString()
    for table in ("metered_transactions", "benchmark_transactions", "payment_bookings"):
        assert scans(plan, table) == 1, table


def test_snapshot_days_move_four_times(as_at_scale, stored):
    plan = physical(snapshot_arm(stored, PERIODS, daily_payments(stored, PERIODS)))
    (way,) = ways_to(plan, "snapshot_days")
    assert way.count("Exchange") <= 4
    # customer, manager, the loan with its items, payments
    assert sum("Join" in name for name in way) == 4


def test_newest_benchmark_row_is_chosen_before_it_is_described(as_at_scale, stored):
    plan = physical(benchmark_arm(stored, PERIODS, daily_payments(stored, PERIODS)))
    below = []
    for way in ways_to(plan, "benchmark_days"):
        deepest = max(i for i, name in enumerate(way) if "Generate" in name)
        below.append(sum("Join" in name for name in way[deepest:]))
    # One way ends in the explode of a day's periods, below which only the country is met.
    assert min(below) == 1


def test_no_join_sees_the_rows_of_the_calendar(as_at_scale, stored):
    """The last explode of a carried row is above every join of its arm."""
    paid = daily_payments(stored, PERIODS)
    for arm, table in ((metered_arm, "metered_days"), (benchmark_arm, "benchmark_days")):
        ways = ways_to(physical(arm(stored, PERIODS, paid)), table)
        assert ways
        for way in ways:
            first = next(i for i, name in enumerate(way) if "Join" in name)
            # calendar, actual days and payments are spread over the highest join
            assert sum("Generate" in name for name in way[:first]) == 3, way


def test_payments_are_not_sorted_to_meet_the_loans_items(as_at_scale, stored):
    plan = physical(monthly_payments(stored, ZAMBIA, SINCE))
    for table in ("benchmark_transactions", "payment_bookings"):
        (way,) = ways_to(plan, table)
        first = max(i for i, name in enumerate(way) if "Join" in name)
        assert way[first] == "ShuffledHashJoin", way
        assert "Sort" not in way[first:], way


def test_bookings_move_once_above_their_joins(as_at_scale, stored):
    months = payments_of_month(stored, ZAMBIA, SINCE)
    ways = ways_to(physical(usual_bookings(stored, months)), "snapshot_days")
    assert ways
    for way in ways:
        first = next(i for i, name in enumerate(way) if "Join" in name)
        assert way[:first].count("Exchange") == 1, way


def test_snapshots_read_several_times_are_derived_once(as_at_scale, spark):
    for name in ("snapshot_vs_previous_month", "usual_payment_amount"):
        assert KEPT[name] == ("snapshot_days",)
    plan = physical(registered()["snapshot_vs_previous_month"](spark, SF_DIR)).toString()
    assert scans(plan, "lineitem") == 0
    assert "staged-snapshot_days-" in plan


def test_profiles_keep_no_hash_table_of_whole_rows(as_at_scale, stored):
    """Copies go by a sort: no aggregate lies between a system's result and its last join."""
    plan = physical(first_payment_profile(stored, AS_OF))
    for table, times in (("metered_accounts", 2), ("loan_accounts", 2)):
        ways = ways_to(plan, table)
        assert len(ways) == times
        for way in ways:
            first = next(i for i, name in enumerate(way) if "Join" in name)
            assert not any("Aggregate" in name for name in way[:first]), way
            assert "Window" in way[:first], way


def test_copies_go_as_with_distinct(spark):
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, None, float("nan")), (1, None, float("nan")), (None, None, None)]
    rows += [(None, None, None), (2, "a", 0.0), (1, "b", 0.0)]
    df = spark.createDataFrame(rows, "k int, `t.x` string, d double").repartition(3)
    found = without_copies(df)
    assert found.columns == df.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, df.distinct().collect()))
    assert found.count() == 5


def test_month_ends_read_each_line_once(as_at_scale, spark):
    for name in ("benchmark_finance_monthly", "metered_finance_monthly", "snapshot_months"):
        plan = physical(StagedTables(spark, SF_DIR)[name]).toString()
        assert scans(plan, "lineitem") == 1, name


def test_month_ends_are_those_of_three_passes(spark):
    days = "(TIMESTAMP '2024-01-31'), (TIMESTAMP '2024-02-20'), (TIMESTAMP '2024-02-20'), (NULL)"
    lines = f"SELECT 1 AS sys, 'l' AS loan, 1 AS k, 2 AS c, 'UG' AS cc, 3 AS q, 4 AS pk, CAST(t AS DATE) AS d FROM VALUES {days} AS v(t)"
    both = [
        spark.sql(f"WITH lin AS ({lines}) {_repeating(sql, 'explode(array({}))')}").collect()
        for sql in (BASE["line_months"], ONE_PASS["line_months"])
    ]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1]))
    assert len(both[0]) == 5


def test_a_loans_lines_move_once_to_become_its_snapshots(as_at_scale, spark):
    plan = physical(StagedTables(spark, SF_DIR)["snapshot_days"])
    (way,) = ways_to(plan, "lineitem")
    assert way.count("Exchange") == 1, way


def test_month_ends_lie_by_loan(as_at_scale, spark):
    """No second exchange where they are grouped by loan, and lines move before they are repeated."""
    months = StagedTables(spark, SF_DIR)["metered_finance_monthly"]
    (way,) = ways_to(physical(months.groupBy("loan_id").count()), "lineitem")
    assert way.count("Exchange") == 1, way
    assert way.index("Generate") < way.index("Exchange"), way


def test_snapshots_are_those_of_two_tables_united(spark):
    """Equal rows once, the largest part per day and per month end, and no end of February 2024."""
    lines = [
        (1, 10, "1998-01-05"),
        (1, 12, "1998-01-05"),
        (1, 11, "1998-01-06"),
        (1, None, "1998-01-30"),
        (1, 9, "1998-01-31"),
        (1, 9, "1998-02-28"),
        (4, 7, None),
        (4, 7, "1998-02-19"),
        (2, 7, "1998-02-19"),
        (None, 7, "1998-02-19"),
        (7, None, "1998-03-22"),
        (7, None, "1998-03-22"),
    ]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate string"
    df = spark.createDataFrame([(k, pk, 1, 1, 5.0, 1.0, "A", "F", d) for k, pk, d in lines], columns)
    df = df.withColumn("l_shipdate", F.to_timestamp("l_shipdate")).repartition(3)
    staged = StagedTables(spark, "")
    staged._given["lineitem"] = df
    sql = TABLES["snapshot_days"]
    united = _repeating(f"WITH {_with_clause(_needed(sql))} {sql}", "explode(array({}))")
    before = spark.sql(united, lineitem=df)
    assert before.count() > 20
    found = staged["snapshot_days"].select(before.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, before.collect()))


@pytest.mark.parametrize(
    "arm, table",
    [(usual_metered, "metered_finance_daily"), (usual_benchmark, "benchmark_finance_daily")],
)
def test_rows_are_multiplied_by_products_after_they_moved(as_at_scale, stored, arm, table):
    ways = ways_to(physical(arm(stored, payments_of_month(stored, ZAMBIA, SINCE))), table)
    # the highest join is by loan; above it reports and products are spread, and nothing moves
    way = max(ways, key=lambda w: sum("Join" in name for name in w))
    first = next(i for i, name in enumerate(way) if "Join" in name)
    assert sum("Generate" in name for name in way[:first]) == 2, way
    assert not any("Exchange" in name or "HashAggregate" in name for name in way[:first]), way


def test_months_lie_by_loan_for_left_joins(as_at_scale, stored):
    """The payments meet a loan's profile and reports where they lie."""
    plan = physical(usual_metered(stored, payments_of_month(stored, ZAMBIA, SINCE)))
    (way,) = ways_to(plan, "metered_transactions")
    highest = max(i for i, name in enumerate(way) if "Join" in name)
    lowest = next(i for i, name in enumerate(way) if "Exchange" in name)
    assert highest < lowest, way


def test_snapshots_of_both_months_move_once(as_at_scale, stored):
    ways = ways_to(physical(usual_bookings(stored, payments_of_month(stored, ZAMBIA, SINCE))), "snapshot_days")
    assert sum("BroadcastExchange" not in way for way in ways) == 1


def test_one_row_per_month_of_equal_and_different_ones(spark):
    others = [c for c in DESCRIBING if c not in ("loan_id", "month_end", "product")]
    rows = [("a", 1, "x", 2), ("a", 1, "x", 2), ("a", 1, "w", 3), ("a", 2, "w", 1), ("a", 2, "v", 1)]
    rows += [(None, 1, "x", 5), (None, 1, None, 5), ("b", None, None, 1)]
    df = spark.createDataFrame(rows, "loan_id string, month_end int, product string, times long")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in others], F.lit(None).cast("string").alias("statistics"))
    df = df.repartition(3)

    def found(frequency):
        kept = _one_per_month(df, frequency)
        assert kept.columns == [*DESCRIBING, "count_loans", "frequency", "statistics"]
        return {tuple(r) for r in kept.select("loan_id", "month_end", "product", "frequency", "count_loans").collect()}

    same = {("a", 2, "v", 1, 1), (None, 1, None, 5, 0), ("b", None, None, 1, 1)}
    assert found(F.sum("times")) == same | {("a", 1, "x", 4, 1)}
    assert found(F.max("times")) == same | {("a", 1, "w", 3, 1)}


def test_profiles_do_not_move_for_their_copies(as_at_scale, stored):
    """Copies are looked for where the last join leaves the rows, before the products are spread."""
    plan = physical(first_payment_profile(stored, AS_OF))
    for table in ("metered_accounts", "loan_accounts"):
        for way in ways_to(plan, table):
            first = next(i for i, name in enumerate(way) if "Join" in name)
            assert "Exchange" not in way[:first], way
            assert way.index("Generate") < way.index("Window"), way


def test_implied_columns_are_not_compared(spark):
    rows = [(1, "a", 5), (1, "a", 5), (1, None, 6), (1, None, 6), (None, None, 7)]
    df = spark.createDataFrame(rows, "k int, x string, follows int").repartition(3)
    found = without_copies(df, implied=["follows"])
    assert found.columns == df.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, df.distinct().collect()))


def test_profiles_of_a_product_with_several_entries(book):
    """One row for each different entry, with its group and size beside each other; without an
    entry one row with neither."""
    def sale(account, product):
        return dict(account_id=account, loan_id=account, sales_order_count=1, product_type=product,
                    country_of_sale="Uganda")

    t = book(
        metered_accounts=[dict(account_id=a) for a in ("a", "a", "b", "c", "d")],
        metered_sales=[sale("a", "Lamp"), sale("b", "TV"), sale("c", None), sale("d", "Lamp")],
        product_mapping=[
            dict(product_type="Lamp", product_group_name="L1", wattage=5),
            dict(product_type="Lamp", product_group_name="L1", wattage=5),
            dict(product_type="Lamp", product_group_name="L2", wattage=None),
            dict(product_type=None, product_group_name="none", wattage=1),
        ],
    )
    found = first_payment_profile(t, AS_OF)
    rows = [tuple(r) for r in found.select("account_id", "product_group_name", "system_size").collect()]
    lamp = [("L1", "5W"), ("L2", None)]
    expected = [(a, *e) for a in ("a", "d") for e in lamp] + [("b", None, None), ("c", None, None)]
    assert sorted(rows, key=str) == sorted(expected, key=str)
