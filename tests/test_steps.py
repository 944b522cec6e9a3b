"""Steps on tiny tables, aimed at ties, NULL keys, fan-out and hot keys."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from loanbook.functions.dates import reporting_periods
from loanbook.operators.agents import (
    earliest_links,
    reassigned_agents,
    sales_span_by_id,
    sales_span_by_name,
)
from loanbook.operators.payer import payment_sources, senders
from loanbook.operators.payments import daily_payments
from loanbook.operators.relational import first_row, left_join_nested, lookup, nested, newest_row
from loanbook.operators.snapshots import carried_over_calendar, latest_per_period
from loanbook.operators.usual import monthly_payments, payment_statistics, payments_of_month, whole_months_after
from loanbook.plans.first_payments import best_loan_per_customer
from loanbook.plans.repayment import SINCE, usual_benchmark, usual_bookings, usual_metered

D = Decimal
PERIODS = reporting_periods(date(2024, 3, 31))


def rows(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=str)


def test_first_row_puts_nulls_last_and_newest_row_first(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 5, 1), ("b", None, 9), (None, 2, 3), (None, 1, 4)],
        "k string, v int, w int",
    )
    assert rows(first_row(df, ["k"], [F.col("v")]), "k", "v", "w") == [
        ("a", 5, 1), ("b", None, 9), (None, 1, 4)]
    assert rows(newest_row(df, ["k"], [F.col("v")]), "k", "v", "w") == [
        ("a", None, 1), ("b", None, 9), (None, 2, 3)]


def test_first_row_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = first_row(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_lookup_gives_the_same_rows_with_keys_dealt(spark):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"), (F.col("id") % 2).alias("n")
    )
    small = spark.createDataFrame(
        [("hot", 1, 0), ("hot", 2, 1), ("cold", 3, 0), (None, 4, 0)], "name string, v int, m int"
    )

    def counted(on, spread_by):
        found = lookup(left, small, on=on, spread_by=spread_by)
        return sorted(map(tuple, found.groupBy("k", "v").count().collect()), key=str)

    assert counted([("k", "name")], ()) == counted([("k", "name")], ["id"]) == [
        ("hot", 1, 2000), ("hot", 2, 2000), (None, None, 1000)]
    both = [("k", "name"), ("n", "m")]
    assert counted(both, ()) == counted(both, ["id"]) == [
        ("hot", 1, 1000), ("hot", 2, 1000), (None, None, 1000)]


def test_rows_without_a_key_are_dealt_over_all_tasks(spark):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a"), F.col("id"))).alias("agent")
    )
    agents = spark.range(9000).select(F.concat(F.lit("a"), F.col("id")).alias("name"))

    def largest(spread_by):
        found = lookup(left, agents, on=[("agent", "name")], spread_by=spread_by)
        counts = found.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in counts) == 9000
        return max(r["count"] for r in counts)

    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert largest(()) > 3000
        assert largest(["id"]) < 1500
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_nested_rows_join_as_a_left_join(spark):
    left = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), (None, 1)], "k string, n int")
    right = spark.createDataFrame(
        [("x", 1, "a"), ("x", 1, "b"), ("x", None, "c"), ("z", 1, "d"), (None, 1, "e")],
        "rk string, rn int, v string",
    )
    wide = left.join(nested(right, ["rk"], "found"), F.col("k") == F.col("rk"), "left").drop("rk")
    mine = left_join_nested(wide, "found", ["rn", "v"], lambda r: r["rn"] == F.col("n"))
    plain = left.join(right, (F.col("k") == F.col("rk")) & (F.col("n") == F.col("rn")), "left").drop("rk")
    assert sorted(map(tuple, mine.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_statistics_of_a_month_are_whole():
    assert whole_months_after(date(2023, 12, 31)) == date(2023, 12, 31)
    assert whole_months_after(date(2024, 1, 15)) == date(2023, 12, 31)
    assert whole_months_after(date(2024, 1, 31)) == date(2024, 1, 31)


def test_latest_row_serves_two_periods(book):
    t = book(benchmark_days=[
        dict(loan_id="x", benchmark_date=date(2024, 2, 10), days_elapsed=1),
        dict(loan_id="x", benchmark_date=date(2024, 2, 20), days_elapsed=2),
        dict(loan_id="y", benchmark_date=date(2024, 3, 31), days_elapsed=3),
        dict(loan_id="z", benchmark_date=date(2023, 3, 30), days_elapsed=4),
    ])
    latest = latest_per_period(t["benchmark_days"], PERIODS, "benchmark_date", "loan_id")
    assert rows(latest, "period", "loan_id", "days_elapsed") == [
        ("current month", "x", 2), ("last month", "x", 2), ("last year", "z", 4)]
    spread = carried_over_calendar(
        t["benchmark_days"], PERIODS, "benchmark_date", "loan_id", "report_date")
    assert {tuple(r) for r in spread.groupBy("period").count().collect()} == {
        ("current month", 30), ("last month", 29), ("last year", 30)}


def test_payments_of_three_systems(book):
    t = book(
        benchmark_transactions=[
            dict(loan_id="ugl_1", customer_id="c", transaction_type=kind, portion_interest=D(100),
                 portion_principal=D(900), added_at_utc=datetime(2024, 3, 5, hour))
            for kind, hour in (("Loan Payment", 1), ("Loan Transaction Reversal", 23), ("Fee", 3))
        ] + [dict(loan_id="zml_1", transaction_type="Loan Payment", portion_interest=D(1),
                  portion_principal=D(1), added_at_utc=datetime(2024, 3, 5))],
        metered_transactions=[
            dict(loan_id="m1", customer_id="c", country="UG", transaction_type="Refund",
                 portion_interest=D("1.25"), portion_principal=D("2.50"),
                 added_at_utc=datetime(2024, 2, 29, 12)),
            dict(loan_id="m1", customer_id="c", country="UG", transaction_type="Payment",
                 portion_interest=D(1), portion_principal=D(1),
                 added_at_utc=datetime(2024, 3, 31, 12)),
        ],
        payment_bookings=[
            dict(loan_account_id="ugl_9", customer_id="c", amount=D(5000),
                 transaction_type="RescueChargeTransaction", payment_at=datetime(2023, 3, 1)),
        ],
    )
    assert rows(daily_payments(t, PERIODS), "loan_id", "payment_date", "amount_paid") == [
        ("m1", date(2024, 2, 29), 3.75), ("ugl_1", date(2024, 3, 5), 20.0),
        ("ugl_9", date(2023, 3, 1), 50.0)]


def test_first_of_month_has_no_current_payments(book):
    t = book(metered_transactions=[
        dict(loan_id="m", country="UG", transaction_type="Payment", portion_interest=D(1),
             portion_principal=D(1), added_at_utc=datetime(2024, 4, day)) for day in (1, 30)])
    assert daily_payments(t, reporting_periods(date(2024, 5, 1))).count() == 0
    follow = reporting_periods(date(2024, 5, 1), payments_follow_calendar=True)
    assert daily_payments(t, follow).count() == 2


def payer_book(book):
    def paid(account, payment, sender):
        return (dict(account_id=account, payment_id=payment, transaction_type_id=2),
                dict(id=payment, sender=sender))

    pairs = [paid("a1", "p1", "111"), paid("a2", "p2", "+111"), paid("a3", "p3", "999"),
             paid("a0", "p4", "888"), paid("a4", "p5", None)]
    return book(
        metered_account_transactions=[x for x, _ in pairs] + [
            dict(account_id="a9", payment_id=None, transaction_type_id=2),
            dict(account_id="a9", payment_id="p1", transaction_type_id=7)],
        payments=[y for _, y in pairs],
        persons=[dict(person_id="s1", primary_phone="+111", first_name="Ann", last_name="Lee"),
                 dict(person_id="u1", primary_phone="+222"), dict(person_id="ag", primary_phone="+333")],
        metered_accounts=[dict(account_id="a1", user_id="u1")],
        metered_sales=[dict(account_id="a1", sales_order_count=1, customer_id="s1",
                            associator_id="ag", associator_name="Seller",
                            start_date_utc=datetime(2023, 1, 1)),
                       dict(account_id="a1", sales_order_count=2, customer_id="s1",
                            associator_name="Other", start_date_utc=datetime(2022, 1, 1))],
    )


def test_payer_is_one_row_per_person_and_one_for_all_unknown(book):
    t = payer_book(book)
    assert rows(senders(t), "sender_phone", "account_id") == [
        ("+111", "a1"), ("+888", "a0"), ("+999", "a3"), (None, "a4")]
    found = rows(payment_sources(t), "sender_id", "sender_name", "sender_customer", "user_phone",
                 "associate_name", "associate_phone")
    assert found == [("s1", "Ann Lee", "a1", "+222", "Seller", "+333"),
                     (None, None, "a0", None, None, None)]


def test_best_loan_takes_highest_down_payment_and_null_first(book):
    def item(loan, money, master=1):
        return dict(loan_account_id=loan, master_loan_item=master, account_type="CREDIT",
                    down_payment=money)

    t = book(
        loan_accounts=[dict(loan_account_id=x, customer_id=c) for x, c in
                       (("l1", "c1"), ("l2", "c1"), ("l3", "c2"), ("l4", "c2"), ("l5", "c3"))],
        order_items=[item("l1", D(5)), item("l2", D(9)), item("l1", D(99), master=0),
                     item("l3", D(7)), item("l4", None), item("l5", D(1), master=0)],
    )
    assert rows(best_loan_per_customer(t), "customer_id", "loan_account_id") == [
        ("c1", "l2"), ("c2", "l4")]


def usual_book(book):
    def paid(amount, day, hour=12):
        return dict(loan_id="z1", country="ZM", transaction_type_id=2, id=f"{amount}{day}{hour}",
                    portion_interest=D(0), portion_principal=D(amount),
                    added_at_utc=datetime(2024, 1, day, hour, 30))

    return book(
        metered_transactions=[paid(30, 2), paid(30, 3), paid(20, 4), paid(20, 5), paid(50, 31, 22),
                              dict(paid(40, 9), transaction_type_id=4),
                              dict(paid(40, 9), country="UG")],
        country_timezones=[dict(iso_2_abbreviation="ZM", default_timezone="Africa/Lusaka")],
        metered_finance_daily=[dict(loan_id="z1", daily_rate=D(10), paid_in_month=D(1))],
        metered_finance_monthly=[dict(loan_id="z1", report_date=date(2024, 1, 31),
                                      paid_in_month=D(7), months_since_loan_start=3)],
    )


def with_months(t, naive_local=False):
    return t, payments_of_month(t, "ZM", SINCE, naive_local)


def test_usual_amount_takes_the_smaller_on_a_tie_and_the_local_month(book):
    found = rows(usual_metered(*with_months(usual_book(book))), "month_end", "trans_amount", "frequency",
                 "lighting_days_paid_for", "paid_mtd", "months_since_loan_start", "region")
    assert found == [(date(2024, 1, 31), 20.0, 2, 2.0, 7.0, "3", ""),
                     (date(2024, 2, 29), 50.0, 1, 5.0, 1.0, "", "")]


def test_repeated_dimension_rows_multiply_frequency_where_rows_are_counted(book):
    t = usual_book(book)
    doubled = t["metered_finance_daily"].union(t["metered_finance_daily"])
    t["metered_finance_daily"] = doubled
    found = rows(usual_metered(*with_months(t)), "trans_amount", "frequency")
    assert found == [(20.0, 4), (50.0, 2)]


def account_side(item_rows=1):
    return dict(
        loan_accounts=[dict(loan_account_id="b1", sales_case_id="sc", daily_rate=D(1000),
                            loan_type="paygo", handover_at_utc=datetime(2023, 12, 1))],
        order_items=[dict(sales_case_id="sc", loan_account_id="b1", country="ZM",
                          down_payment_days=5)] * item_rows,
        country_timezones=[dict(iso_2_abbreviation="ZM", default_timezone="Africa/Lusaka")],
    )


def test_benchmark_counts_different_transactions(book):
    t = book(
        benchmark_transactions=[
            dict(id=i, loan_id="b1", transaction_type="Loan Payment", portion_interest=D(0),
                 portion_principal=D(cents), added_at_utc=datetime(2024, 1, 5))
            for i, cents in (("i1", 3000), ("i1", 3000), ("i2", 2000), ("i3", 2000))],
        benchmark_finance_daily=[dict(loan_id="b1", daily_rate=D(10))] * 2,
        **account_side(item_rows=3),
    )
    assert rows(usual_benchmark(*with_months(t)), "trans_amount", "frequency") == [(20.0, 2)]
    # the statistics count joined rows: 4 transactions, 3 items, 2 x 2 finance rows
    assert rows(payment_statistics(t, "ZM", SINCE), "total_transactions", "max_payment",
                "min_payment", "avg_payment") == [(48, 30.0, 20.0, 25.0)]


def test_swapped_amounts_of_the_snapshot_system(book):
    t = book(
        payment_bookings=[dict(payment_booking_id="p", loan_account_id="b1", amount=D(2000),
                               transaction_type="PaymentChargeTransaction",
                               transaction_at=datetime(2024, 1, 31, 22, 30))],
        snapshot_days=[dict(loan_account_id="b1", snapshot_at=date(2024, 2, 29), customer_id="c",
                            snapshot_prev_month=date(2024, 1, 31), state="maintained",
                            outstanding_amount=D(5000)),
                       dict(loan_account_id="b1", snapshot_at=date(2024, 1, 31), customer_id="c",
                            state="maintained", outstanding_amount=D(9000), months_on_book=2)],
        **account_side(),
    )
    # at 2024-01-31: 61 days since handover, no duration known, so the month's 31 days at 10
    columns = ("month_end", "paid_mtd", "expected_ongoing_mtd", "expected_mtd")
    assert rows(usual_bookings(*with_months(t)), *columns) == [(date(2024, 2, 29), 40.0, 310.0, None)]
    assert rows(usual_bookings(*with_months(t), fix_admin_order=True), *columns) == [
        (date(2024, 2, 29), 40.0, None, 310.0)]
    naive = usual_bookings(*with_months(t, True))
    assert rows(naive, "month_end") == [(date(2024, 1, 31),)]


def agent_book(book):
    return book(
        loan_accounts=[dict(loan_account_id="l1", customer_id="c1", state="active"),
                       dict(loan_account_id="l2", customer_id="c2", state="paid_off")],
        customers=[dict(customer_id="c1", application_by_contractor_id="g1",
                        application_by_contractor_name="Ann", adopted_by_contractor_id="g2"),
                   dict(customer_id="c2", application_by_contractor_id="g1",
                        assigned_to_contractor_name="Bob")],
        order_items=[dict(customer_id=c, account_type="CREDIT", sale_type="FIRST SALE",
                          sales_order_submitted_by_type=by, master_loan_item=1,
                          handover_at_utc=datetime(2024, month, 1))
                     for c, by, month in (("c1", "Contractor", 1), ("c1", "User", 3),
                                          ("c1", None, 4), ("c2", "Contractor", 2))],
        metered_sales=[dict(associator_name="ANN", date_fulfilled_utc=datetime(2023, 5, 5))],
        reassigned_customers=[dict(customer_id="c1", to_contractor_id="g2",
                                   to_contractor_name="ann", to_contractor_role_name="agent")],
    )


def test_agent_spans(book):
    t = agent_book(book)
    assert rows(sales_span_by_name(t), "sa_name", "first_sale", "last_sale") == [
        ("ann", date(2023, 5, 5), date(2024, 1, 1))]
    assert rows(sales_span_by_id(t), "associator_id", "first_sale", "last_sale") == [
        ("g1", date(2024, 1, 1), date(2024, 4, 1))]
    assert rows(reassigned_agents(t), "customer_id", "reassigned_agent_id", "last_sale_at") == [
        ("c1", "g2", date(2024, 1, 1)), ("c2", None, None)]


def test_earliest_link_is_a_contractors(book):
    t = book(contractor_links=[
        dict(powerhub_entry_id="g", powerhub_entry_type=kind, fenixdb_entry_id=entry,
             inserted_at_utc=datetime(2020, 1, day))
        for kind, entry, day in (("Customer", "x", 1), ("Contractor", "y", 3), ("Contractor", "z", 2))])
    assert rows(earliest_links(t), "powerhub_entry_id", "fenixdb_entry_id") == [("g", "z")]
