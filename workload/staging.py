"""Loan-book tables derived from the given star schema.

Each table is one SELECT in the part of SQL that Spark and DuckDB share, so the
queries and their check SQL start from the same rows. An order is a loan: its key
modulo 3 tells the system, its key divided by 10 the customer, and the customer's
key the country. Lines give transactions and daily rows, dates move on by 26
years. Every row is computed from one input row, or by grouping on a key, so the
tables grow with the data.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from loanbook.session import written
from loanbook.sources import conform

AS_OF = date(2024, 3, 31)
DRIVER_TABLES = ("orders", "lineitem", "customer", "supplier", "part")
SHIFT = 9496  # days of 26 years


def _country(c: str) -> str:
    return (
        f"CASE WHEN {c} % 25 < 9 THEN 'UG' WHEN {c} % 25 < 16 THEN 'ZM' "
        f"WHEN {c} % 25 = 16 THEN 'KE' WHEN {c} % 25 = 17 THEN 'TZ' WHEN {c} % 25 = 18 THEN 'RW' "
        f"WHEN {c} % 25 = 19 THEN 'MZ' WHEN {c} % 25 = 20 THEN 'CI' WHEN {c} % 25 = 21 THEN 'BJ' "
        f"WHEN {c} % 25 = 22 THEN 'NG' WHEN {c} % 25 = 23 THEN 'DE' ELSE 'SN' END"
    )


def _country_name(code: str) -> str:
    return (
        f"CASE {code} WHEN 'UG' THEN 'Uganda' WHEN 'ZM' THEN 'Zambia' WHEN 'KE' THEN 'Kenya' "
        f"WHEN 'TZ' THEN 'Tanzania' WHEN 'RW' THEN 'Rwanda' WHEN 'MZ' THEN 'Mozambique' "
        f"WHEN 'CI' THEN 'Côte d''Ivoire' WHEN 'BJ' THEN 'Benin' WHEN 'NG' THEN 'Nigeria' "
        f"WHEN 'DE' THEN 'Germany' ELSE 'Senegal' END"
    )


def _div(value: str, by: int) -> str:
    return f"CAST(floor({value} / {by}) AS BIGINT)"


def _money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def _int(expression: str) -> str:
    return f"CAST({expression} AS INT)"


def _month_start(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


# Base rows: loans, lines, customers, and lines repeated over a few days.
BASE: dict[str, str] = {
    "ord": f"""
        SELECT o_orderkey AS k, o_orderkey % 3 AS sys, {_div('o_orderkey', 10)} AS c,
               {_country(_div('o_orderkey', 10))} AS cc,
               lower({_country(_div('o_orderkey', 10))}) || 'l_' || o_orderkey AS loan,
               {_div('o_orderkey', 8)} AS pk, {_div('o_orderkey', 150)} AS agent,
               o_orderdate + INTERVAL '{SHIFT}' DAY AS ts,
               CAST(o_orderdate + INTERVAL '{SHIFT}' DAY AS DATE) AS d,
               {_money('o_totalprice')} AS price, o_orderstatus AS st, o_orderpriority AS pr
        FROM {{orders}}""",
    "lin": f"""
        SELECT l_orderkey AS k, l_orderkey % 3 AS sys, {_div('l_orderkey', 10)} AS c,
               {_country(_div('l_orderkey', 10))} AS cc,
               lower({_country(_div('l_orderkey', 10))}) || 'l_' || l_orderkey AS loan,
               l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln,
               {_int('l_quantity')} AS q, {_money('l_extendedprice')} AS price,
               l_returnflag AS rf, l_linestatus AS ls,
               l_shipdate + INTERVAL '{SHIFT}' DAY AS ts,
               CAST(l_shipdate + INTERVAL '{SHIFT}' DAY AS DATE) AS d
        FROM {{lineitem}}""",
    "cus": f"""
        SELECT c_custkey AS c, {_country('c_custkey')} AS cc, c_name AS name,
               c_mktsegment AS segment, {_div('c_custkey', 15)} AS agent
        FROM {{customer}}""",
    "agt": f"""
        SELECT s_suppkey AS a, s_name AS name, {_country('s_suppkey')} AS cc FROM {{supplier}}""",
    # a line's days: the ship date, the day after, and nine days after
    "line_days": """
        SELECT sys, loan, k, c, cc, CAST(d + v.n AS DATE) AS day, max(q) AS q, max(pk) AS pk
        FROM (SELECT *, EACH(0, 1, 9) AS n FROM lin) AS v
        GROUP BY sys, loan, k, c, cc, CAST(d + v.n AS DATE)""",
    # a line's payments: four in two weeks, two amounts
    "line_payments": f"""
        SELECT sys, loan, k, c, cc, pk, sk, ln, q,
               loan || '_' || ln || '_' || pk || '_' || v.n AS id,
               ts + (v.n * INTERVAL '1' DAY) + (ln * INTERVAL '3' HOUR)
                  + INTERVAL '90' MINUTE AS ts,
               {_money('200 + q * 10 + (CASE WHEN v.n = 2 OR v.n = 5 OR (v.n = 11 AND q < 20) '
                       'THEN 150 ELSE 0 END)')} AS amount
        FROM (SELECT *, EACH(0, 2, 5, 11) AS n FROM lin) AS v""",
    # a line's month ends: of its month and of the month before
    "line_months": f"""
        SELECT sys, loan, k, c, cc, month_end, max(q) AS q, max(pk) AS pk FROM (
          SELECT sys, loan, k, c, cc, q, pk, last_day(d) AS month_end FROM lin
          UNION ALL
          SELECT sys, loan, k, c, cc, q, pk, {_month_start('d')} - 1 AS month_end FROM lin
          UNION ALL
          SELECT sys, loan, k, c, cc, q, pk, last_day(d + 11) AS month_end FROM lin
        ) AS x GROUP BY sys, loan, k, c, cc, month_end""",
}

# The same rows where Spark derives them: each line is read once, not once for each month end,
# and a loan's lines move together, before they are repeated.
ONE_PASS: dict[str, str] = {
    "line_months": f"""
        SELECT sys, loan, k, c, cc, month_end, max(q) AS q, max(pk) AS pk FROM (
          SELECT sys, loan, k, c, cc, q, pk,
                 EACH(last_day(d), {_month_start('d')} - 1, last_day(d + 11)) AS month_end
          FROM (SELECT sys, loan, k, c, cc, q, pk, d FROM lin DISTRIBUTE BY loan) AS y
        ) AS x GROUP BY sys, loan, k, c, cc, month_end""",
}

_RATE_CENTS = "CASE WHEN k % 13 = 0 THEN NULL ELSE 1000 + (k % 37) * 50 END"
_PRODUCT = "(CASE WHEN pk % 5 = 0 THEN 'TV ' ELSE 'Lamp ' END) || (pk % 200)"

TABLES: dict[str, str] = {
    "benchmark_days": f"""
        SELECT loan AS loan_id, 'c_' || c AS customer_id,
               CASE WHEN pk % 4 = 0 THEN 'active' ELSE 'repayment' END AS loan_state,
               day AS benchmark_date, {_money('500 + (k % 40) * 25')} AS daily_rate,
               {_int('pk % 900')} AS days_elapsed
        FROM line_days WHERE sys = 2""",
    "benchmark_transactions": f"""
        SELECT id, loan AS loan_id, 'c_' || c AS customer_id,
               CASE WHEN pk % 6 = 0 THEN 'Fee' WHEN pk % 6 = 1 THEN 'Loan Transaction Reversal'
                    ELSE 'Loan Payment' END AS transaction_type,
               ts AS added_at_utc, {_money('amount * 10')} AS portion_interest,
               {_money('amount * 90')} AS portion_principal
        FROM line_payments WHERE sys = 2""",
    "benchmark_finance_daily": f"""
        SELECT loan AS loan_id, 'c_' || c AS customer_id, {_PRODUCT} AS product_type,
               {_money('20 + k % 60')} AS daily_rate, {_money('k % 700')} AS paid_in_month,
               {_money('k % 500')} AS expected_in_month_ongoing,
               {_money('k % 900')} AS expected_in_month_total
        FROM ord WHERE sys = 2
        UNION ALL
        SELECT loan, 'c_' || c, {_PRODUCT}, {_money('20 + k % 60')}, {_money('k % 700')},
               {_money('k % 500')}, {_money('k % 900')}
        FROM ord WHERE sys = 2 AND k % 50 = 2""",
    "benchmark_finance_monthly": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id, 'c_' || c AS customer_id,
               month_end AS report_date,
               CASE WHEN pk % 3 = 0 THEN 'repayment' ELSE 'active' END AS loan_state,
               CAST(month_end + {_int('(pk % 80) - 20')} AS DATE) AS loan_contract_end_date,
               {_int('k % 30')} AS months_since_loan_start, {_int('pk % 900')} AS days_elapsed,
               CASE WHEN q % 3 = 0 THEN NULL ELSE {_money('q * 11')} END AS paid_in_month,
               {_money('q * 7')} AS expected_in_month_ongoing,
               {_money('q * 9')} AS expected_in_month_total,
               month_end AS benchmark_date,
               CASE WHEN q % 5 = 0 THEN CAST(month_end AS TIMESTAMP) END AS loan_cancelled_at_utc,
               CASE WHEN q % 7 = 0 THEN CAST(month_end AS TIMESTAMP) END AS loan_completed_at_utc,
               CAST(q AS DOUBLE) / 50 AS percent_locked, {_int('q % 40')} AS par_days
        FROM line_months WHERE sys = 2""",
    "benchmark_finance_calculations": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id, month_end AS report_date,
               {_money('q * 900')} AS remaining_all, {_money('q * 800')} AS remaining_net_unfin,
               {_money('q * 40')} AS accounts_receivable_all,
               {_money('q * 30')} AS accounts_receivable_net_unfin
        FROM line_months WHERE sys = 2 AND pk % 9 <> 0""",
    "snapshot_days": f"""
        SELECT loan AS loan_account_id, 'c_' || c AS customer_id, day AS snapshot_at,
               {_month_start('day')} - 1 AS snapshot_prev_month,
               CASE pk % 9 WHEN 0 THEN 'rescheduled' WHEN 1 THEN 'canceled' WHEN 2 THEN 'paid_off'
                           WHEN 3 THEN 'Maintained' ELSE 'maintained' END AS state,
               {_int('pk % 40')} AS months_on_book,
               CASE WHEN pk % 17 = 0 THEN CAST(day AS TIMESTAMP) END AS terminated_at,
               {_money('(100 + pk % 300) * 100')} AS outstanding_amount
        FROM (SELECT loan, c, day, pk FROM line_days WHERE sys = 1
              UNION
              SELECT loan, c, month_end AS day, pk FROM line_months WHERE sys = 1
                AND month_end NOT IN (DATE '2024-02-29')) AS x
        """,
    "snapshot_months": f"""
        SELECT loan AS loan_account_id, 'c_' || c AS customer_id, month_end AS snapshot_at,
               CASE pk % 6 WHEN 0 THEN 'paid_off' WHEN 1 THEN 'in_grace_period'
                           WHEN 2 THEN 'exceeded_grace_period' WHEN 3 THEN 'exceeded_loan_period'
                           ELSE 'maintained' END AS state,
               {_int('pk % 20')} AS months_on_book
        FROM line_months WHERE sys = 1""",
    "payment_bookings": f"""
        SELECT id AS payment_booking_id, loan AS loan_account_id, 'c_' || c AS customer_id,
               {_money('amount * 100')} AS amount,
               CASE WHEN pk % 5 = 0 THEN 'Other' WHEN pk % 5 = 1 THEN 'RescueChargeTransaction'
                    ELSE 'PaymentChargeTransaction' END AS transaction_type,
               ts AS payment_at, ts AS transaction_at
        FROM line_payments WHERE sys = 1""",
    "metered_accounts": f"""
        SELECT 'a_' || k AS account_id, 'p_' || c AS user_id, 'c_' || c AS customer_id,
               {_country_name('cc')} AS country, d AS account_start_date,
               {_int('k % 40')} AS account_days_locked,
               CAST(k % 40 AS DOUBLE) / 40 AS account_percent_locked,
               {_int('k % 90 - 30')} AS account_days_til_lockout,
               {_int('k % 25')} AS account_max_consecutive_days_locked,
               CASE st WHEN 'F' THEN 'enabled' ELSE 'disabled' END AS account_state
        FROM ord WHERE sys = 0""",
    "metered_account_transactions": f"""
        SELECT 'a_' || k AS account_id,
               CASE WHEN pk % 19 = 0 THEN NULL ELSE 'pay_' || k || '_' || ln || '_' || pk END
                 AS payment_id,
               CASE pk % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 7 END
                 AS transaction_type_id
        FROM lin WHERE sys = 0""",
    "payments": """
        SELECT DISTINCT 'pay_' || k || '_' || ln || '_' || pk AS id,
               CASE WHEN pk % 7 = 0 THEN '999' || k WHEN pk % 7 = 1 THEN '256' || sk
                    ELSE '+256' || sk END AS sender
        FROM lin WHERE sys = 0 AND pk % 11 <> 0""",
    "metered_cancellations": """
        SELECT loan AS loan_id, CASE WHEN pk % 2 = 0 THEN 'moved' ELSE 'unhappy' END
                 AS cancellation_reason,
               CAST(day AS TIMESTAMP) + INTERVAL '7' HOUR AS change_recorded_at_utc
        FROM line_days WHERE sys = 0 AND q % 6 = 0""",
    "metered_days": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id, 'c_' || c AS customer_id,
               day AS benchmark_date, {_money('5 + k % 20')} AS daily_rate,
               CASE WHEN q < 10 THEN NULL WHEN q < 20 THEN FALSE ELSE TRUE END AS in_repayment,
               {_int('pk % 900')} AS days_elapsed
        FROM line_days WHERE sys = 0""",
    "metered_finance_daily": f"""
        SELECT loan AS loan_id, 'c_' || c AS customer_id, 'p_' || c AS customer_id_fenixdb,
               {_PRODUCT} AS product_type,
               {_money('CASE WHEN k % 29 = 0 THEN 0 ELSE 20 + k % 60 END')} AS daily_rate,
               {_money('k % 700')} AS paid_in_month,
               {_money('k % 500')} AS expected_in_month_ongoing,
               {_money('k % 900')} AS expected_in_month_total
        FROM ord WHERE sys = 0 AND k % 31 <> 0""",
    "metered_finance_monthly": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id, 'c_' || c AS customer_id,
               month_end AS report_date,
               CAST(month_end + {_int('(pk % 80) - 20')} AS DATE) AS loan_contract_end_date,
               CASE WHEN pk % 3 = 0 THEN 'closed' ELSE 'open' END AS loan_state,
               CASE WHEN q % 8 = 0 THEN NULL ELSE {_int('k % 30')} END AS months_since_loan_start,
               {_int('pk % 900')} AS days_elapsed,
               CASE WHEN q % 9 = 0 THEN 'inactive' ELSE 'active' END AS active,
               CASE WHEN q % 3 = 0 THEN NULL ELSE {_money('q * 11')} END AS paid_in_month,
               {_money('q * 7')} AS expected_in_month_ongoing,
               {_money('q * 9')} AS expected_in_month_total
        FROM line_months WHERE sys = 0""",
    "metered_loans": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id,
               CASE st WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'pending' END
                 AS loan_state,
               CASE WHEN k % 7 = 0 THEN ts END AS cancellation_date_utc,
               CASE WHEN k % 11 = 0 THEN ts END AS payoff_date_utc,
               {_int('k % 60 - 20')} AS prepaid_days_remaining,
               CASE WHEN k % 7 = 0 THEN 'moved' END AS cancellation_reason,
               price AS amount_remaining_interest_accrued_to_date,
               {_money('price + 10')} AS amount_remaining_all_interest,
               {_money('k % 800')} AS paid_principal, {_money('k % 90')} AS paid_interest,
               {_money('k % 950')} AS amount_expected
        FROM ord WHERE sys = 0""",
    "metered_sales": f"""
        SELECT loan AS loan_id, 'a_' || k AS account_id, 'p_' || c AS customer_id,
               'p_' || c AS customer_id_fenixdb,
               {_int('1 + ' + _div('(k % 10)', 4))} AS sales_order_count, ts AS start_date_utc,
               ts + INTERVAL '1' DAY AS date_fulfilled_utc, 'p_' || agent AS associator_id,
               CASE WHEN k % 23 = 0 THEN NULL WHEN k % 2 = 0 THEN 'AGENT ' || agent
                    ELSE 'Agent ' || agent END AS associator_name,
               'agent' AS associator_role, 'Town-' || (k % 12) AS associator_location,
               'm_' || (agent % 9) AS associator_manager_id,
               'Manager ' || (agent % 9) AS associator_manager_name, 'lead' AS manager_role,
               CASE WHEN k % 4 = 0 THEN 'Town-' || (k % 15) END AS sale_location,
               'solar' AS product_category, {_PRODUCT} AS product_type,
               'plan ' || (k % 3) AS payment_plan, {_money('k % 120')} AS deposit_amount,
               {_int('200 + k % 500')} AS loan_duration, {_money('5 + k % 20')} AS daily_rate,
               CASE WHEN k % 41 = 0 THEN NULL ELSE {_country_name('cc')} END AS country_of_sale,
               {_int('k % 40')} AS introductory_period, {_money('k % 77')} AS total_interest,
               {_money('k % 777')} AS total_principal, 'Powerhub' AS fulfillment_source
        FROM ord WHERE sys = 0""",
    "metered_transactions": f"""
        SELECT id, loan AS loan_id, 'c_' || c AS customer_id, cc AS country,
               CASE pk % 7 WHEN 0 THEN 'Payment' WHEN 1 THEN 'Reversal' WHEN 2 THEN 'Transfer'
                    WHEN 3 THEN 'Automatic Arrears Payment' WHEN 4 THEN 'Refund'
                    WHEN 5 THEN 'Payment' ELSE 'Correction' END AS transaction_type,
               {_int('CASE pk % 7 WHEN 0 THEN 2 WHEN 1 THEN 18 WHEN 2 THEN 20 WHEN 3 THEN 24 '
                     'WHEN 4 THEN 61 WHEN 5 THEN 2 ELSE 99 END')} AS transaction_type_id,
               ts AS added_at_utc, {_money('amount / 4')} AS portion_interest,
               {_money('amount - amount / 4')} AS portion_principal
        FROM line_payments WHERE sys = 0""",
    "person_demographics": f"""
        SELECT 'p_' || c AS person_id, 'Region ' || (c % 6) AS region,
               'Subcounty ' || (c % 50) AS subcounty,
               CASE WHEN c % 7 = 0 THEN NULL ELSE 'District ' || (c % 30) END AS district,
               CASE WHEN c % 8 = 0 THEN NULL ELSE 'Parish ' || (c % 99) END AS parish,
               'farmer' AS occupation, CASE WHEN c % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
               {_int('20 + c % 50')} AS age, 'English' AS primary_language,
               'Luganda' AS messaging_language
        FROM cus""",
    "persons": """
        SELECT 'p_' || c AS person_id, '+256' || c AS primary_phone,
               '+257' || c AS secondary_phones, '+258' || c AS alternate_contacts,
               name AS first_name, CASE WHEN c % 27 = 0 THEN NULL ELSE segment END AS last_name,
               'f_' || c AS fenixdb_user_id,
               CASE WHEN c % 5 = 0 THEN NULL ELSE 'near tree ' || (c % 70) END AS landmark
        FROM cus""",
    "contractor_links": """
        SELECT 'ag_' || a AS powerhub_entry_id,
               CASE WHEN v.n = 3 THEN 'Customer' ELSE 'Contractor' END AS powerhub_entry_type,
               'p_' || (a + v.n) AS fenixdb_entry_id,
               TIMESTAMP '2020-01-01 00:00:00' + ((a * 7 + v.n * 5) % 11) * INTERVAL '1' DAY
                 AS inserted_at_utc
        FROM (SELECT *, EACH(0, 1, 3) AS n FROM agt) AS v""",
    "contractors": """
        SELECT 'ag_' || a AS contractor_id, name,
               CASE WHEN a % 6 = 0 THEN NULL ELSE 'S' || a END AS surname
        FROM agt""",
    "customers": f"""
        SELECT 'c_' || c AS customer_id, CASE WHEN cc = 'SN' THEN NULL ELSE cc END AS country,
               'Area1 ' || (c % 9) AS area1, 'Area2 ' || (c % 23) AS area2,
               'Area3 ' || (c % 51) AS area3, 'Area4 ' || (c % 77) AS area4,
               'h_' || (c % 40) AS hub_id, 'trader' AS occupation,
               CASE WHEN c % 2 = 0 THEN 'f' ELSE 'm' END AS gender, 'English' AS spoken_language,
               'French' AS reading_language,
               CASE WHEN c % 12 = 0 THEN NULL ELSE 'ag_' || agent END
                 AS application_by_contractor_id,
               CASE WHEN c % 12 = 0 THEN NULL WHEN c % 2 = 0 THEN 'Agent ' || agent
                    ELSE 'Seller ' || agent END AS application_by_contractor_name,
               'agent' AS application_by_contractor_role,
               'm_' || (agent % 9) AS application_coordinator_id,
               'Manager ' || (agent % 9) AS application_coordinator_name,
               'lead' AS application_coordinator_role,
               'ag_' || (agent + c % 2) AS assigned_to_contractor_id,
               'Agent ' || (agent + c % 2) AS assigned_to_contractor_name,
               CASE WHEN c % 3 = 0 THEN 'ag_' || (agent + c % 5) END AS adopted_by_contractor_id
        FROM cus""",
    "customer_contacts": f"""
        SELECT 'c_' || c AS customer_id, name AS customer_name,
               CASE WHEN c % 31 = 0 THEN NULL
                    ELSE CAST(DATE '1950-01-01' + {_int('(c * 37) % 27500')} AS DATE) END
                 AS birthdate,
               '+256' || c AS primary_phone_number,
               CASE WHEN c % 3 = 0 THEN NULL ELSE '+259' || c END AS other_phone_numbers,
               'Street ' || (c % 90) AS address,
               CASE WHEN c % 4 = 0 THEN NULL ELSE 'left of shop ' || (c % 13) END AS directions,
               'la_' || (c % 60) AS location_area_id
        FROM cus""",
    "loan_accounts": f"""
        SELECT loan AS loan_account_id, 'c_' || c AS customer_id,
               CASE sys WHEN 1 THEN 'admin' ELSE 'alms' END AS source,
               CASE WHEN sys = 2 THEN 'paygo' WHEN k % 2 = 0 THEN 'paygo' ELSE 'arrears' END
                 AS loan_type,
               CASE st WHEN 'F' THEN 'active' WHEN 'O' THEN 'Active' ELSE 'paid_off' END AS state,
               'detail ' || st AS state_detailed, 'sc_' || k AS sales_case_id,
               ts AS handover_at_utc, {_int('k % 40')} AS days_locked,
               CAST(k % 40 AS DOUBLE) / 40 AS percent_locked,
               {_int('k % 90 - 30')} AS days_til_lockout, {_int('6 + k % 30')} AS
               installment_periods,
               CASE WHEN k % 14 = 0 THEN 0 WHEN k % 14 = 1 THEN NULL ELSE {_int('7 + k % 24')} END
                 AS installment_period_days,
               {_money('CASE WHEN k % 18 = 0 THEN 0 ELSE (100 + k % 400) * 100 END')}
                 AS initial_installment,
               {_money('CASE WHEN k % 25 = 0 THEN 0 ELSE (1000 + k % 4000) * 100 END')}
                 AS initial_amount,
               {_money(_RATE_CENTS)} AS daily_rate, {_int('300 + k % 500')} AS loan_duration,
               CAST(d + {_int('400 + k % 300')} AS DATE) AS loan_contract_end_date,
               last_day(CAST(d + {_int('k % 200')} AS DATE)) AS last_benchmark_date,
               CASE WHEN k % 17 = 0 THEN ts END AS defaulted_at_utc,
               CASE WHEN k % 13 = 0 THEN ts + INTERVAL '2' DAY END AS canceled_at_utc,
               CASE WHEN k % 11 = 0 THEN ts + INTERVAL '3' DAY END AS rescheduled_at_utc,
               CASE WHEN st = 'P' THEN ts + INTERVAL '4' DAY END AS paid_off_at_utc,
               {_int('k % 120')} AS par_days,
               CASE WHEN k % 13 = 0 THEN 'returned' END AS cancel_comment,
               {_money('(k % 3000) * 100')} AS amount_remaining,
               {_money('(k % 5000) * 100')} AS loan_amount,
               {_money('(k % 900) * 100')} AS amount_paid_minus_down_payment,
               {_money('(k % 950) * 100')} AS amount_expected_minus_down_payment,
               {_money('(k % 310) * 100')} AS remaining_principal,
               {_money('(k % 51) * 100')} AS remaining_interest_accrued,
               {_money('(k % 61) * 100')} AS remaining_interest_total,
               {_money('(k % 71) * 100')} AS expected_interest,
               {_money('(k % 81) * 100')} AS expected_principal, {_int('k % 2')} AS migrated_loan,
               'risk ' || (k % 4) AS risk_category, {_int('k % 15')} AS days_prepaid_remaining,
               ts AS inserted_at_utc
        FROM ord WHERE sys <> 0""",
    "order_items": f"""
        SELECT 'it_' || k || '_' || v.n AS sales_order_item_id, 'sc_' || k AS sales_case_id,
               loan AS loan_account_id, 'c_' || c AS customer_id,
               CASE WHEN k % 6 = 0 THEN NULL ELSE 'pf_' || k END AS loan_portfolio_id,
               CASE WHEN k % 16 = 0 THEN 'CASH' ELSE 'CREDIT' END AS account_type,
               CASE WHEN k % 4 = 1 THEN 'UPGRADE' ELSE 'FIRST SALE' END AS sale_type,
               {_int('1 - v.n')} AS master_loan_item,
               {_int('CASE WHEN k % 22 = 0 THEN 2 ELSE 1 END')} AS sales_case_rank, cc AS country,
               ts AS handover_at_utc,
               CASE WHEN k % 32 = 0 THEN 'Other' ELSE 'ReadyPay' END AS fenix_product_category,
               'ReadyPay' AS product_line_segment_name, 'Line ' || (pk % 8) AS product_line_name,
               CASE WHEN k % 37 = 0 THEN 'COVID relief'
                    WHEN k % 38 = 0 THEN 'Cooperative kit'
                    ELSE ' ' || {_PRODUCT} || ' ' END AS product_name,
               CASE WHEN k % 9 = 0 THEN NULL ELSE (k % 24) || 'm' END AS payment_plan,
               {_money('(k % 60) * 100 + k % 3 * 50')} AS down_payment,
               {_int('k % 45')} AS down_payment_days,
               CASE WHEN k % 21 = 0 THEN NULL ELSE {_int('300 + k % 500')} END AS loan_duration,
               {_money(_RATE_CENTS)} AS daily_rate,
               {_money('CASE WHEN k % 26 = 0 THEN 0 ELSE 5000 END')} AS installment_amount,
               {_money('(k % 33) * 100')} AS total_interest,
               {_money('(k % 333) * 100')} AS principal_price,
               CASE WHEN k % 10 = 3 THEN 'User' ELSE 'Contractor' END
                 AS sales_order_submitted_by_type,
               'Agent ' || agent AS sales_order_submitted_by_name
        FROM (SELECT *, EACH(0, 1) AS n FROM ord) AS v
        WHERE sys <> 0 AND (v.n = 0 OR k % 4 = 0)""",
    "reassigned_customers": f"""
        SELECT 'c_' || c AS customer_id, 'ag_' || (agent + c % 5) AS to_contractor_id,
               'Agent ' || (agent + c % 5) AS to_contractor_name,
               'agent' AS to_contractor_role_name,
               TIMESTAMP '2023-01-01 05:00:00' + ((c * 11 + v.n * 90) % 500) * INTERVAL '1' DAY
                 AS created_at_utc
        FROM (SELECT *, EACH(0, 1) AS n FROM cus) AS v WHERE c % 6 = 0""",
    "reschedule_requests": """
        SELECT loan AS resultant_loan_account_id FROM ord WHERE sys = 1 AND k % 8 = 0""",
    "sales_cases": f"""
        SELECT 'sc_' || k AS sales_case_id,
               CASE WHEN k % 20 = 0 THEN NULL
                    ELSE 'town-' || (k % 15) || ' (hub ' || (k % 4) || ')' END AS hub_name,
               {_int('CASE WHEN k % 28 = 0 THEN 0 ELSE 1 END')} AS finalized
        FROM ord WHERE sys <> 0""",
    "agent_managers": f"""
        SELECT DISTINCT 'ag_' || {_div('c', 15)} AS sales_agent_id, day AS benchmark_date,
               'Manager ' || ({_div('c', 15)} % 9) AS manager_name
        FROM line_days WHERE sys <> 0""",
    "agent_mapping": """
        SELECT 'ag_' || a AS sales_agent_id, 'Mapped ' || a AS sales_agent,
               CASE WHEN a % 2 = 0 THEN NULL ELSE 'mm_' || a END AS coordinator_id,
               CASE WHEN a % 2 = 0 THEN NULL ELSE 'Coordinator ' || a END AS coordinator_name,
               CASE WHEN a % 3 = 0 THEN NULL ELSE 'Mapped region ' || (a % 4) END AS region
        FROM agt WHERE a % 5 <> 0""",
    "channel_mapping": """
        SELECT 'it_' || k || '_0' AS order_item_id,
               CASE WHEN k % 6 = 0 THEN '' ELSE 'pf_' || k END AS account_id, loan AS loan_id,
               CASE WHEN k % 10 = 1 THEN 'Other' ELSE 'Solarhub' END AS source,
               CASE WHEN k % 8 = 1 THEN NULL ELSE 'AGENT ' || (agent + 1) END AS sales_agent_name
        FROM ord WHERE sys <> 0 AND k % 3 <> 0 AND k % 5 <> 0""",
    "countries": f"""
        SELECT DISTINCT cc AS iso_2_abbreviation, cc || 'X' AS iso_3_abbreviation,
               {_country_name('cc')} AS name FROM cus""",
    "country_names": f"""
        SELECT DISTINCT cc AS iso_2_abbreviation, {_country_name('cc')} AS name FROM cus""",
    "country_timezones": """
        SELECT DISTINCT cc AS iso_2_abbreviation,
               CASE cc WHEN 'UG' THEN 'Africa/Kampala' WHEN 'KE' THEN 'Africa/Nairobi'
                    WHEN 'TZ' THEN 'Africa/Dar_es_Salaam' WHEN 'ZM' THEN 'Africa/Lusaka'
                    WHEN 'RW' THEN 'Africa/Kigali' WHEN 'MZ' THEN 'Africa/Maputo'
                    WHEN 'BJ' THEN 'Africa/Porto-Novo' WHEN 'NG' THEN 'Africa/Lagos'
                    WHEN 'CI' THEN 'Africa/Abidjan' END AS default_timezone
        FROM cus""",
    "first_payments": f"""
        SELECT 'a_' || k AS account_id, 'c_' || c AS customer_id, loan AS loan_id,
               CAST(d + 7 AS DATE) AS first_payment_due,
               CAST(d + 30 AS DATE) AS first_payment_due_monthly,
               CAST(d + 10 AS DATE) AS first_payment_due_w_grace,
               CAST(d + 33 AS DATE) AS first_payment_due_monthly_w_grace,
               {_int('CASE WHEN k % 7 < 2 THEN 1 ELSE 0 END')} AS missed_first_payment,
               {_int('CASE WHEN k % 9 < 2 THEN 1 ELSE 0 END')} AS missed_first_payment_monthly,
               {_int('k % 12')} AS days_issued_sale_date
        FROM ord WHERE k % 24 <> 0""",
    "fx_rates": f"""
        SELECT DISTINCT last_day(d) AS month, {_country_name('cc')} AS country,
               CAST(3000 + CAST(year(d) AS INT) % 100 * 10 + month(d) AS DOUBLE)
                 AS end_of_month_rate
        FROM ord WHERE cc <> 'ZM'""",
    "location_areas": """
        SELECT DISTINCT 'la_' || (c % 60) AS location_area_id, 'XX' AS country,
               'Zone ' || (c % 3) AS area0, 'Area1 ' || (c % 6) AS area1,
               CASE WHEN c % 20 = 0 THEN NULL ELSE 'Area2 ' || (c % 20) END AS area2,
               CASE WHEN c % 2 = 0 THEN NULL ELSE 'Area3 ' || (c % 30) END AS area3,
               CASE WHEN c % 4 = 0 THEN NULL ELSE 'Area4 ' || (c % 60) END AS area4
        FROM cus""",
    "locations": """
        SELECT DISTINCT 'Town-' || (c % 13) AS location, 'Place ' || (c % 13) AS region FROM cus""",
    "portfolio_owners": """
        SELECT loan AS loan_id,
               CASE WHEN k % 9 = 0 THEN 'Collection_Champions'
                    WHEN k % 9 = 3 THEN 'Collection-Champions'
                    WHEN k % 9 = 6 THEN NULL ELSE 'Person ' || (k % 40) END AS person_responsible
        FROM ord WHERE k % 4 = 0
        UNION ALL
        SELECT loan, 'Person ' || (k % 7) FROM ord WHERE k % 44 = 0""",
    "product_mapping": f"""
        SELECT DISTINCT {_PRODUCT} AS product_type, 'Group ' || (pk % 6) AS product_group_name,
               {_int('CASE pk % 200 WHEN 0 THEN NULL WHEN 1 THEN 20 WHEN 2 THEN 21 WHEN 3 THEN 79 '
                     'WHEN 4 THEN 80 WHEN 6 THEN 200 WHEN 7 THEN 201 '
                     'ELSE (pk % 200) + 5 END')} AS wattage
        FROM (SELECT p_partkey % 600 AS pk FROM {{part}}) AS x""",
    "area_manager": """
        SELECT DISTINCT 'Area2 ' || (c % 23) AS area2, 'Area manager ' || (c % 23) AS manager,
               'Managed region ' || (c % 23 % 7) AS region
        FROM cus WHERE c % 23 <> 5""",
    "hub_stock_point": """
        SELECT DISTINCT 'h_' || (c % 40) AS hub_id, 'Stock region ' || (c % 40 % 6) AS region,
               'Stock county ' || (c % 40 % 11) AS subcounty
        FROM cus WHERE c % 40 <> 8""",
}


# Tables that Spark derives in another way than DuckDB, with the same rows. A loan's lines move once
# and become its days in place: each day with the largest part of the lines' days, each month end
# with that of the lines' months, equal ones once.
DERIVED_ONCE: dict[str, str] = {
    "snapshot_days": TABLES["snapshot_days"][: TABLES["snapshot_days"].index("FROM (")]
    + f"""FROM (
          SELECT lower({_country(_div('k', 10))}) || 'l_' || k AS loan, {_div('k', 10)} AS c,
                 inline(array_distinct(transform(
                   filter(ordered, (u, i) -> (NOT u.month OR u.day NOT IN (DATE '2024-02-29'))
                     AND (i + 1 = size(ordered) OR get(ordered, i + 1).month <> u.month
                          OR NOT get(ordered, i + 1).day <=> u.day)),
                   u -> named_struct('day', u.day, 'pk', u.pk))))
          FROM (
            SELECT k, array_sort(flatten(transform(collect_list(named_struct('d', d, 'pk', pk)),
                     x -> array(
                       named_struct('month', FALSE, 'day', x.d, 'pk', x.pk),
                       named_struct('month', FALSE, 'day', CAST(x.d + 1 AS DATE), 'pk', x.pk),
                       named_struct('month', FALSE, 'day', CAST(x.d + 9 AS DATE), 'pk', x.pk),
                       named_struct('month', TRUE, 'day', last_day(x.d), 'pk', x.pk),
                       named_struct('month', TRUE, 'day', {_month_start('x.d')} - 1, 'pk', x.pk),
                       named_struct('month', TRUE, 'day', last_day(x.d + 11), 'pk', x.pk)
                     )))) AS ordered
            FROM lin WHERE sys = 1 GROUP BY k) AS y) AS x""",
}


def _repeating(sql: str, call: str) -> str:
    """Replace EACH(a, b, ...), which repeats a row per value, by an engine's own call."""
    inner = r"[^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)*"  # brackets of two levels
    return re.sub(rf"EACH\(({inner})\)", lambda found: call.format(found.group(1)), sql)


def _words(sql: str) -> set[str]:
    return set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))


def _needed(sql: str) -> list[str]:
    """Derived tables ``sql`` reads, directly or not, inputs before users."""
    known = {**BASE, **TABLES}
    found: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in found and name in _words(text):
                visit(known[name])
                found.append(name)

    visit(sql)
    return found


def _with_clause(names: list[str], instead: dict[str, str] | None = None) -> str:
    known = {**BASE, **TABLES, **(instead or {})}
    return ",\n".join(f"{name} AS ({known[name]})" for name in names)


def check_sql(body: str) -> str:
    """``body`` (a SELECT, or WITH ... SELECT) over derived tables, for DuckDB."""
    ctes = _with_clause(_needed(body)).format(**{t: t for t in DRIVER_TABLES})
    ctes = _repeating(ctes, "unnest([{}])")
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class StagedTables(dict):
    """Derived tables by logical name, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir
        self._given: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._given[name]

    def __missing__(self, name: str) -> DataFrame:
        sql = DERIVED_ONCE.get(name, TABLES[name])
        bases = _needed(sql)
        text = f"WITH {_with_clause(bases, ONE_PASS)}\n{sql}" if bases else sql
        text = _repeating(text, "explode(array({}))")
        inputs = {t: self.driver(t) for t in DRIVER_TABLES if "{" + t + "}" in text}
        self[name] = conform(self._spark.sql(text, **inputs), name)
        return self[name]

    def keep(self, name: str) -> None:
        """Derive a table once, for a query that reads it several times, and read it from Parquet.

        The rows are all of the table's, in the shared checkpoint folder.
        """
        self[name] = written(self[name], f"staged-{name}", compression="zstd")
