"""Business rules as pure Column functions.

Rules are first match wins; a comparison with NULL does not match.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.functions.labels import ARREARS, PAYGO
from loanbook.functions.money import ratio, units

# Days of an average month, and the dates on which terms changed.
MONTH_DAYS = 30.5
KE_INTRO_CHANGE = date(2022, 3, 21)
UG_RATE_CHANGE = date(2022, 4, 14)

# Country code to the name used by the rate table.
COUNTRY_NAMES = {
    "BJ": "Benin",
    "CI": "Côte d'Ivoire",
    "KE": "Kenya",
    "MZ": "Mozambique",
    "NG": "Nigeria",
    "RW": "Rwanda",
    "TZ": "Tanzania",
    "UG": "Uganda",
    "ZM": "Zambia",
}

# Countries of sale whose region is the person's district.
DISTRICT_COUNTRIES = ("Uganda", "Mozambique", "Côte d'Ivoire")
# Country codes whose region is the second area level.
SECOND_AREA_COUNTRIES = ("MZ", "CI")


@dataclass
class LoanTerms:
    """The columns the schedule rules read, and those they derive first. Money in cents."""

    country: Column
    loan_type: Column
    state: Column
    snapshot: Column
    handover: Column
    months_on_book: Column
    terminated_at: Column
    item_daily_rate: Column
    initial_installment: Column
    period_days: Column
    periods: Column
    loan_duration: Column
    down_payment_days: Column
    # derived unless given
    elapsed: Column | None = None
    day_of_month: Column | None = None
    duration: Column | None = None
    intro: Column | None = None
    contract_rate: Column | None = None
    daily_rate: Column | None = None
    repayment_rate: Column | None = None

    def __post_init__(self) -> None:
        derived = {
            "elapsed": lambda: F.datediff(self.snapshot, F.to_date(self.handover)),
            "day_of_month": lambda: F.dayofmonth(self.snapshot),
            "duration": lambda: F.coalesce(self.loan_duration, self.periods * self.period_days),
            "intro": lambda: intro_days(self),
            "contract_rate": lambda: contract_rate(
                self.item_daily_rate, self.initial_installment, self.period_days
            ),
            "daily_rate": lambda: daily_rate(self),
            "repayment_rate": lambda: repayment_rate(self),
        }
        for name, rule in derived.items():
            if getattr(self, name) is None:
                setattr(self, name, rule())

    @property
    def is_paygo(self) -> Column:
        return self.loan_type == PAYGO


def with_terms(df: DataFrame, terms: LoanTerms) -> tuple[DataFrame, LoanTerms]:
    """Hold every term as a column of its own, so the rules compute it once per row."""
    names = [field.name for field in fields(LoanTerms)]
    held = df.withColumns({f"term_{name}": getattr(terms, name) for name in names})
    return held, LoanTerms(**{name: F.col(f"term_{name}") for name in names})


def intro_days(terms: LoanTerms) -> Column:
    """days after handover in which nothing is expected yet."""
    kenya = terms.country == "KE"
    not_paygo = terms.loan_type != PAYGO
    return (
        F.when(kenya & (not_paygo | (terms.snapshot < F.lit(KE_INTRO_CHANGE))), F.lit(MONTH_DAYS))
        .when(kenya & terms.is_paygo, F.lit(7.0))
        .when(terms.country.isin("TZ", "RW") & not_paygo, F.lit(MONTH_DAYS))
        .otherwise(terms.down_payment_days.cast("double"))
    )


def contract_rate(item_rate: Column, installment: Column, period_days: Column) -> Column:
    """Rate per day before rounding: the item's, else the installment over its period."""
    per_day = ratio(units(F.coalesce(installment, F.lit(0))), period_days)
    return F.coalesce(units(item_rate), per_day)


def daily_rate(terms: LoanTerms) -> Column:
    """rounded rate per day."""
    return F.round(terms.contract_rate)


def repayment_rate(terms: LoanTerms) -> Column:
    """F2b: rounded rate per day of a loan in repayment."""
    installment = units(terms.initial_installment)
    in_uganda = terms.country == "UG"
    early = F.to_date(terms.handover) <= F.lit(UG_RATE_CHANGE)
    return F.round(
        F.when(terms.is_paygo & in_uganda & early, installment / MONTH_DAYS)
        .when(terms.is_paygo & in_uganda, installment)
        .when(
            (terms.loan_type == ARREARS) & terms.country.isin("UG", "ZM"),
            units(terms.item_daily_rate),
        )
        .otherwise(installment / MONTH_DAYS)
    )


def _by_months_on_book(terms: LoanTerms, months: Column, otherwise: Column) -> Column:
    """Tail shared by the schedule rules: too young, past its periods, else ``otherwise``."""
    return (
        F.when(months < 2, F.lit(0.0))
        .when(months - 2 > terms.periods, F.lit(0.0))
        .otherwise(otherwise)
    )


def expected_all(terms: LoanTerms) -> Column:
    """amount expected on the snapshot day, whatever the repayment state."""
    intro, rate = terms.intro, terms.daily_rate
    reach = terms.elapsed + intro
    # Within the last month before the planned end the rate stays the same, so
    # that case needs no branch of its own.
    paygo = (
        F.when(terms.elapsed < intro, F.lit(0.0))
        .when(terms.elapsed - intro <= terms.day_of_month, rate)
        .when(reach > terms.duration + terms.day_of_month, F.lit(0.0))
        .otherwise(rate)
    )
    other = F.round(F.coalesce(terms.contract_rate, units(terms.initial_installment) / MONTH_DAYS))
    return (
        F.when(terms.state == "rescheduled", F.lit(0.0))
        .when((terms.country != "KE") & (terms.state == "canceled"), F.lit(0.0))
        .when(terms.state == "paid_off", F.lit(0.0))
        .when(terms.is_paygo, paygo)
        .otherwise(_by_months_on_book(terms, terms.months_on_book, other))
    )


def expected_in_repayment(terms: LoanTerms) -> Column:
    """amount expected on the snapshot day from loans still in repayment."""
    intro, rate = terms.intro, terms.repayment_rate
    paygo = (
        F.when(terms.elapsed < intro, F.lit(0.0))
        .when(terms.elapsed - intro <= terms.day_of_month, (terms.elapsed - intro) * rate)
        .when(terms.elapsed + intro > terms.duration + terms.day_of_month, F.lit(0.0))
        .otherwise(rate)
    )
    other = F.coalesce(rate, units(terms.initial_installment) / MONTH_DAYS)
    return (
        F.when(terms.state.isin("rescheduled", "canceled"), F.lit(0.0))
        .when(terms.terminated_at.isNotNull(), F.lit(0.0))
        .when(terms.is_paygo, paygo)
        .otherwise(_by_months_on_book(terms, terms.months_on_book, other))
    )


def expected_by_contract(
    contract_end: Column, day: Column, rate: Column, in_repayment: Column, due: Column
) -> Column:
    """F3f/F3a: before the contract's end the rate, after it what is due if in repayment."""
    return (
        F.when(contract_end > day, rate)
        .when(in_repayment, due)
        .otherwise(F.lit(0.0))
    )


def rate_while_due(elapsed: Column, duration: Column, intro: Column, rate: Column) -> Column:
    """The rate while the loan runs, 0 after it or when its length is unknown."""
    return F.when(elapsed <= duration + intro, rate).otherwise(F.lit(0.0))


def expected_month_to_date(terms: LoanTerms, rate: Column) -> Column:
    """amount expected in the snapshot's month. ``rate`` is the loan's, in units a day."""
    intro = terms.down_payment_days
    elapsed, day, end = terms.elapsed, terms.day_of_month, terms.loan_duration
    paygo = (
        F.when(elapsed < intro, F.lit(0.0))
        .when(elapsed - intro <= day, (elapsed - intro) * rate)
        .when(elapsed + intro > end + day, F.lit(0.0))
        .when(elapsed + intro > end, (day - elapsed - end + intro) * rate)
        .otherwise(rate * day)
    )
    other = terms.contract_rate * day
    return (
        F.when(terms.state == "rescheduled", F.lit(0.0))
        .when(
            (terms.country != "KE") & (terms.loan_type != PAYGO) & (terms.state == "canceled"),
            F.lit(0.0),
        )
        .when(terms.state == "paid_off", F.lit(0.0))
        .when(terms.is_paygo, paygo)
        .otherwise(_by_months_on_book(terms, terms.months_on_book, other))
    )


def expected_ongoing_month_to_date(terms: LoanTerms, rate: Column) -> Column:
    """amount expected from ongoing loans. A paygo loan past its end gives NULL."""
    intro = terms.down_payment_days
    paygo = (
        F.when(terms.elapsed < intro, F.lit(0.0))
        .when(terms.elapsed <= terms.loan_duration + intro, rate)
        .otherwise(F.lit(None).cast("double"))
    )
    return (
        F.when(terms.state.isin("rescheduled", "canceled"), F.lit(0.0))
        .when(terms.terminated_at.isNotNull(), F.lit(0.0))
        .when(terms.is_paygo, paygo)
        .otherwise(_by_months_on_book(terms, terms.months_on_book, rate * terms.day_of_month))
    )


def rhythm(light_days: Column) -> Column:
    """how often the usual amount has to be paid. Labels are fixed values."""
    return (
        F.when(light_days.between(1, 2), "daily (every 1-2days)")
        .when(light_days.between(3, 5), "daily(every 3-4days)")
        .when(light_days.between(5, 7), "Weekly(every 5-7days)")
        .when(light_days.between(12, 16), "bi-weekly")
        .when(light_days.between(17, 35), "monthly")
        .when(light_days > 35, "beyond monthly")
        .otherwise("Irregular")
    )


def product_segment(wattage: Column, product_name: Column) -> Column:
    """F8: segment by wattage; a television lifts a product to the middle one."""
    return (
        F.when(wattage.between(80, 200), "High end")
        .when(wattage.between(21, 79) | product_name.contains("TV"), "Medium")
        .when(wattage <= 20, "Entry Level")
        .otherwise("EXCEPTION")
    )


def has_owner(loan_listed: Column, responsible: Column) -> Column:
    """The loan is listed under somebody other than the collection champions."""
    # `_` is a wildcard of LIKE, as it is in the rule's own wording
    return loan_listed & ~responsible.like("Collection_Champions")


def orphan_status(
    owned: Column, reassigned_at: Column, last_sale: Column, report_date: Column
) -> Column:
    """a loan is no orphan when owned, reassigned by then, or its agent sold lately."""
    return (
        F.when(owned, "non_orphan")
        .when(reassigned_at <= report_date, "non_orphan")
        .when(last_sale >= F.date_sub(report_date, 60), "non_orphan")
        .otherwise("orphan")
    )


def sale_region(country_name: Column, district: Column, region: Column) -> Column:
    """F10, metered system: district in some countries, else region."""
    return F.when(country_name.isin(*DISTRICT_COUNTRIES), district).otherwise(region)


def area_region(country: Column, area1: Column, area2: Column) -> Column:
    """F10, benchmark system: second area level in some countries, else the first."""
    return F.when(country.isin(*SECOND_AREA_COUNTRIES), area2).otherwise(area1)


def overdue_days(days_left: Column) -> Column:
    """days past due from a signed count of days left."""
    return F.when(days_left < 0, -days_left).otherwise(F.lit(0))


def age_in_years(birthdate: Column, as_of: date) -> Column:
    """difference of the years, for a birthdate before ``as_of``."""
    return F.when(birthdate < F.lit(as_of), F.lit(as_of.year) - F.year(birthdate))


def light_days(payment: Column, rate: Column) -> Column:
    """days of light a payment buys."""
    return F.round(ratio(payment, rate), 0)


def months_on_book(days_elapsed: Column) -> Column:
    """F14"""
    return F.round(days_elapsed / F.lit(MONTH_DAYS), 0)


def country_name(code: Column) -> Column:
    """name of a country code; any other text stays as it is."""
    name = code
    for short, long in COUNTRY_NAMES.items():
        name = F.when(code == short, long).otherwise(name)
    return name


def plan_label(product: Column, down_payment: Column, plan: Column) -> Column:
    """F16: product, down payment in whole units, and plan."""
    whole = F.floor(units(down_payment)).cast("string")
    return F.concat(product, F.lit(" _ "), whole, F.lit("dp _ "), plan)


def international_phone(sender: Column) -> Column:
    """A phone number with its leading plus sign."""
    return F.when(F.left(sender, F.lit(1)) == "+", sender).otherwise(F.concat(F.lit("+"), sender))


def hub_location(hub_name: Column) -> Column:
    """Location named by a hub: the text before the first bracket, in title case.

    A word starts after every sign that is neither letter nor digit. Spark's
    ``initcap`` starts one after white space only, so each such sign is followed
    by a marked blank while the case is set.
    """
    before = F.split_part(hub_name, F.lit("("), F.lit(1))
    spaced = F.regexp_replace(before, r"([^\p{L}\p{N}])", "$1\u0001 ")
    return F.trim(F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit("")))
