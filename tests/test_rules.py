"""Every branch of the business rules, on hand-worked rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanbook.functions import rules
from loanbook.functions.money import ratio, units

TERMS = (
    "country string, loan_type string, state string, snapshot date, handover timestamp, "
    "months_on_book int, terminated_at timestamp, item_daily_rate decimal(18,2), "
    "initial_installment decimal(18,2), period_days int, periods int, loan_duration int, "
    "down_payment_days int"
)
SNAPSHOT = date(2024, 3, 10)
PLAIN = dict(
    country="UG", loan_type="paygo", state="maintained", snapshot=SNAPSHOT, handover=None,
    months_on_book=5, terminated_at=None, item_daily_rate=150000, initial_installment=4575000,
    period_days=30, periods=24, loan_duration=100, down_payment_days=7,
)  # daily rate 1,500, installment 45,750 = 1,500 a day over 30.5 days


def elapsed(days, **changes):
    start = datetime.combine(SNAPSHOT - timedelta(days=days), datetime.min.time())
    return dict(PLAIN, handover=start, **changes)


def evaluate(spark, rule, *cases):
    names = [part.strip().split(" ")[0] for part in TERMS.replace("18,2", "18.2").split(",")]
    money = {"item_daily_rate", "initial_installment"}
    rows = [
        tuple(
            Decimal(case[n]) if n in money and case[n] is not None else case[n] for n in names
        )
        for case in cases
    ]
    df = spark.createDataFrame(rows, TERMS)
    df, terms = rules.with_terms(df, rules.LoanTerms(**{n: F.col(n) for n in names}))
    return [row[0] for row in df.select(rule(terms)).collect()]


def scalar(spark, schema, rows, make):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(make(*[F.col(c) for c in df.columns])).collect()]


def test_intro_days(spark):
    cases = [
        (dict(country="KE", loan_type="arrears"), 30.5),
        (dict(country="KE", snapshot=date(2022, 3, 20)), 30.5),
        (dict(country="KE", snapshot=date(2022, 3, 21)), 7.0),
        (dict(country="TZ", loan_type="arrears"), 30.5),
        (dict(country="RW", loan_type="arrears"), 30.5),
        (dict(country="TZ"), 12.0),
        (dict(country="UG", loan_type="arrears"), 12.0),
        (dict(country="KE", loan_type=None, snapshot=date(2024, 1, 1)), 12.0),
        (dict(country=None, down_payment_days=None), None),
    ]
    rows = [elapsed(10, **{"down_payment_days": 12, **c}) for c, _ in cases]
    assert evaluate(spark, lambda t: t.intro, *rows) == [want for _, want in cases]


def test_daily_rate_falls_back_to_installment(spark):
    rows = [
        elapsed(1),
        elapsed(1, item_daily_rate=None),
        elapsed(1, item_daily_rate=None, period_days=0),
        elapsed(1, item_daily_rate=None, period_days=None),
        elapsed(1, item_daily_rate=None, initial_installment=None),
        elapsed(1, item_daily_rate=150050),
    ]
    assert evaluate(spark, lambda t: t.daily_rate, *rows) == [1500, 1525, None, None, 0, 1501]


def test_repayment_rate(spark):
    rows = [
        dict(PLAIN, handover=datetime(2022, 4, 14)),
        dict(PLAIN, handover=datetime(2022, 4, 15)),
        elapsed(1, loan_type="arrears"),
        elapsed(1, loan_type="arrears", country="ZM"),
        elapsed(1, loan_type="arrears", country="KE"),
        elapsed(1, loan_type="paygo", country="ZM"),
    ]
    assert evaluate(spark, lambda t: t.repayment_rate, *rows) == [
        1500, 45750, 1500, 1500, 1500, 1500]


# snapshot is the 10th: intro 7, duration 100
SCHEDULE = [
    (elapsed(50, state="rescheduled"), 0, 0),
    (elapsed(50, state="canceled"), 0, 0),
    (elapsed(50, state="canceled", country="KE"), 1500, 0),
    (elapsed(50, state="paid_off"), 0, 45750),
    (elapsed(50, terminated_at=datetime(2024, 1, 1)), 1500, 0),
    (elapsed(6), 0, 0),  # before the introduction is over
    (elapsed(7), 1500, 0 * 45750),  # its last day
    (elapsed(17), 1500, 10 * 45750),  # as many days after it as the day of the month
    (elapsed(18), 1500, 45750),
    (elapsed(93), 1500, 45750),  # 93 + 7 = duration
    (elapsed(94), 1500, 45750),
    (elapsed(103), 1500, 45750),  # 103 + 7 = duration + day of month
    (elapsed(104), 0, 0),
    (elapsed(104, loan_duration=None), 1500, 45750),  # 24 periods of 30 days
    (elapsed(50, loan_type="arrears", months_on_book=1), 0, 0),
    (elapsed(50, loan_type="arrears", months_on_book=2), 1500, 1500),
    (elapsed(50, loan_type="arrears", months_on_book=26), 1500, 1500),
    (elapsed(50, loan_type="arrears", months_on_book=27), 0, 0),
    (elapsed(50, loan_type="arrears", months_on_book=None), 1500, 1500),
    (elapsed(50, loan_type="arrears", item_daily_rate=None, period_days=0), 1500, 1500),
    (dict(PLAIN), 1500, 45750),  # no handover date: no comparison matches
]


def test_expected_all(spark):
    assert evaluate(spark, rules.expected_all, *[c for c, _, _ in SCHEDULE]) == [
        want for _, want, _ in SCHEDULE
    ]


def test_expected_in_repayment(spark):
    assert evaluate(spark, rules.expected_in_repayment, *[c for c, _, _ in SCHEDULE]) == [
        want for _, _, want in SCHEDULE
    ]


# the loan's own rate is 1,500; day of month 10
MONTHLY = [
    (elapsed(50, state="rescheduled"), 0, 0),
    (elapsed(50, state="canceled"), 15000, 0),  # paygo loans are not excepted here
    (elapsed(50, state="canceled", loan_type="arrears"), 0, 0),
    (elapsed(50, state="paid_off"), 0, 1500),
    (elapsed(50, terminated_at=datetime(2024, 1, 1)), 15000, 0),
    (elapsed(6), 0, 0),
    (elapsed(9), 3000, 1500),
    (elapsed(17), 15000, 1500),
    (elapsed(18), 15000, 1500),
    (elapsed(94), (10 - 94 - 100 + 7) * 1500, 1500),
    (elapsed(104), 0, 1500),
    (elapsed(108), 0, None),
    (elapsed(50, loan_type="arrears", months_on_book=1), 0, 0),
    (elapsed(50, loan_type="arrears", months_on_book=27), 0, 0),
    (elapsed(50, loan_type="arrears"), 15000, 15000),
    (elapsed(50, loan_type="arrears", item_daily_rate=None), 15250, None),
]


@pytest.mark.parametrize(
    "rule, position", [(rules.expected_month_to_date, 1), (rules.expected_ongoing_month_to_date, 2)]
)
def test_monthly_schedule(spark, rule, position):
    found = evaluate(
        spark, lambda t: rule(t, units(t.item_daily_rate)), *[case[0] for case in MONTHLY]
    )
    assert found == [case[position] for case in MONTHLY]


def test_expected_by_contract(spark):
    day = date(2024, 3, 10)
    rows = [
        (date(2024, 3, 11), day, 5.0, False, 3.0),
        (date(2024, 3, 10), day, 5.0, True, 3.0),
        (date(2024, 3, 10), day, 5.0, False, 3.0),
        (None, day, 5.0, True, 3.0),
        (None, day, 5.0, None, 3.0),
    ]
    schema = "e date, d date, r double, i boolean, due double"
    assert scalar(spark, schema, rows, rules.expected_by_contract) == [5, 3, 0, 3, 0]


def test_rate_while_due(spark):
    rows = [(107, 100, 7, 2.0), (108, 100, 7, 2.0), (1, None, 7, 2.0), (None, 100, 7, 2.0)]
    assert scalar(spark, "e int, d int, i int, r double", rows, rules.rate_while_due) == [2, 0, 0, 0]


def test_rhythm(spark):
    days = [0, 1, 2, 3, 5, 6, 7, 8, 11, 12, 16, 17, 35, 36, -1, None]
    daily, few, week = "daily (every 1-2days)", "daily(every 3-4days)", "Weekly(every 5-7days)"
    odd = "Irregular"
    assert scalar(spark, "d double", [(float(d) if d is not None else None,) for d in days],
                  rules.rhythm) == [
        odd, daily, daily, few, few, week, week, odd, odd, "bi-weekly", "bi-weekly", "monthly",
        "monthly", "beyond monthly", odd, odd]


def test_product_segment(spark):
    rows = [(20, "x"), (21, "x"), (79, "x"), (80, "x"), (200, "x"), (201, "x"), (201, "a TV"),
            (10, "TV"), (100, "TV"), (None, "TV"), (None, None)]
    assert scalar(spark, "w int, p string", rows, rules.product_segment) == [
        "Entry Level", "Medium", "Medium", "High end", "High end", "EXCEPTION", "Medium",
        "Medium", "High end", "Medium", "EXCEPTION"]


def test_orphan_status(spark):
    day = date(2024, 3, 31)
    rows = [
        (True, None, None, day, "non_orphan"),
        (False, date(2024, 3, 31), None, day, "non_orphan"),
        (False, date(2024, 4, 1), None, day, "orphan"),
        (None, None, day - timedelta(days=60), day, "non_orphan"),
        (None, None, day - timedelta(days=61), day, "orphan"),
        (None, None, None, day, "orphan"),
    ]
    schema = "o boolean, r date, s date, d date, want string"
    df = spark.createDataFrame(rows, schema)
    for row in df.select(
        rules.orphan_status(*[F.col(c) for c in "orsd"]).alias("found"), "want"
    ).collect():
        assert row.found == row.want


def test_owner_pattern_treats_underscore_as_any_sign(spark):
    rows = [(True, "Collection_Champions"), (True, "Collection-Champions"), (True, "Ann"),
            (True, None), (False, "Ann")]
    assert scalar(spark, "l boolean, p string", rows, rules.has_owner) == [
        False, False, True, None, False]


def test_small_rules(spark):
    assert scalar(spark, "d int", [(-4,), (0,), (3,), (None,)], rules.overdue_days) == [4, 0, 0, 0]
    ages = scalar(spark, "b date", [(date(1990, 12, 1),), (date(2030, 1, 1),), (None,)],
                  lambda b: rules.age_in_years(b, date(2024, 3, 31)))
    assert ages == [34, None, None]
    assert scalar(spark, "p double, r double", [(10.0, 4.0), (9.0, 4.0), (1.0, 0.0), (1.0, None)],
                  rules.light_days) == [3, 2, None, None]
    assert scalar(spark, "d int", [(15,), (16,), (61,), (None,)], rules.months_on_book) == [
        0, 1, 2, None]
    assert scalar(spark, "c string", [("UG",), ("CI",), ("Uganda",), (None,)],
                  rules.country_name) == ["Uganda", "Côte d'Ivoire", "Uganda", None]
    assert scalar(spark, "s string", [("25677",), ("+25677",), (None,)],
                  rules.international_phone) == ["+25677", "+25677", None]
    assert scalar(spark, "p string, d decimal(18,2), l string",
                  [("Lamp", Decimal(5050), "12m"), ("Lamp", Decimal(5050), None)],
                  rules.plan_label) == ["Lamp _ 50dp _ 12m", None]


def test_regions(spark):
    rows = [("Uganda", "d", "r"), ("Zambia", "d", "r"), ("Côte d'Ivoire", "d", "r"), (None, "d", "r")]
    assert scalar(spark, "c string, d string, r string", rows, rules.sale_region) == [
        "d", "r", "d", "r"]
    rows = [("MZ", "1", "2"), ("CI", "1", "2"), ("UG", "1", "2"), (None, "1", "2")]
    assert scalar(spark, "c string, a string, b string", rows, rules.area_region) == [
        "2", "2", "1", "1"]


def test_hub_location_starts_words_after_any_sign(spark):
    rows = [("kampala-NORTH (hub 2)",), ("  fort portal",), ("o'neil/west(x)",), (None,)]
    assert scalar(spark, "h string", rows, rules.hub_location) == [
        "Kampala-North", "Fort Portal", "O'Neil/West", None]


def test_division(spark):
    assert scalar(spark, "a int", [(150,), (None,)], units) == [1.5, None]
    assert scalar(spark, "a int, b int", [(3, 2), (3, 0), (3, None)], ratio) == [1.5, None, None]
