"""Check SQL for DuckDB: the plain meaning of each registered query.

Written row by row (window ranks, one join after the other, one SELECT per
period rule), not the way the Spark plans get there.
"""

from __future__ import annotations

from datetime import date, timedelta

from workload.staging import check_sql

PERIOD = """
period AS (
  SELECT * FROM (VALUES
    ('current month', DATE '2024-03-01', DATE '2024-03-30', DATE '2024-02-01'),
    ('last month',    DATE '2024-02-01', DATE '2024-02-29', DATE '2024-02-01'),
    ('last year',     DATE '2023-03-01', DATE '2023-03-30', DATE '2023-03-01')
  ) AS v(period, day_from, day_to, back_from)
),
cal AS (
  SELECT period, CAST(unnest(generate_series(day_from, day_to, INTERVAL 1 DAY)) AS DATE) AS day
  FROM period
)"""

ALL_PAID = """
all_paid AS (
  SELECT customer_id, loan_id, CAST(added_at_utc AS DATE) AS payment_date,
         CAST(sum(portion_interest + portion_principal) AS DOUBLE) / 100 AS amount_paid
  FROM benchmark_transactions
  WHERE transaction_type IN ('Loan Payment', 'Loan Transaction Reversal')
    AND loan_id LIKE 'ug%' GROUP BY ALL
  UNION ALL
  SELECT customer_id, loan_id, CAST(added_at_utc AS DATE),
         CAST(sum(portion_interest + portion_principal) AS DOUBLE)
  FROM metered_transactions
  WHERE transaction_type IN ('Payment', 'Reversal', 'Transfer', 'Automatic Arrears Payment',
                             'Refund')
    AND country = 'UG' GROUP BY ALL
  UNION ALL
  SELECT customer_id, loan_account_id, CAST(payment_at AS DATE),
         CAST(sum(amount) AS DOUBLE) / 100
  FROM payment_bookings
  WHERE transaction_type IN ('PaymentChargeTransaction', 'RescueChargeTransaction')
    AND loan_account_id LIKE 'ug%' GROUP BY ALL
)"""

# payments as each period takes them: by month, and up to yesterday's day of month
PAID = f"""{ALL_PAID},
paid AS (
  SELECT 'current month' AS period, * FROM all_paid
  WHERE date_trunc('month', payment_date) = DATE '2024-03-01'
  UNION ALL
  SELECT 'last month', * FROM all_paid
  WHERE payment_date >= DATE '2024-02-01' AND payment_date < DATE '2024-03-01'
    AND day(payment_date) <= 30
  UNION ALL
  SELECT 'last year', * FROM all_paid
  WHERE payment_date >= DATE '2023-03-01' AND payment_date < DATE '2024-03-01'
    AND day(payment_date) <= 30
)"""

METERED_ARM = """
sale AS (
  SELECT s.*, CASE WHEN country_of_sale IN ('Uganda', 'Mozambique', 'Côte d''Ivoire')
                   THEN h.district ELSE h.region END AS sale_region
  FROM metered_sales AS s LEFT JOIN person_demographics AS h
    ON s.customer_id_fenixdb = h.person_id
),
m_ranked AS (
  SELECT p.period, x.*, r.loan_state AS report_state, r.loan_contract_end_date AS cend,
         s.product_type, s.associator_manager_name AS lead, s.country_of_sale, s.sale_region,
         row_number() OVER (PARTITION BY p.period, x.loan_id
                            ORDER BY x.benchmark_date DESC NULLS FIRST) AS newest
  FROM metered_days AS x
  JOIN period AS p ON x.benchmark_date BETWEEN p.back_from AND p.day_to
  LEFT JOIN metered_finance_monthly AS r ON r.loan_id = x.loan_id
    AND r.report_date = CAST(date_trunc('month', x.benchmark_date) AS DATE) - 1
  LEFT JOIN sale AS s ON s.loan_id = x.loan_id AND s.account_id = x.account_id
    AND x.days_elapsed > s.introductory_period
  WHERE s.country_of_sale = 'Uganda'
),
m_rows AS (
  SELECT w.period, cal.day, w.loan_id AS lid, w.customer_id AS lcustomer, w.cend AS lend,
         w.daily_rate AS lrate, coalesce(w.in_repayment, FALSE) AS lrep, w.days_elapsed AS lel,
         w.product_type AS lproduct, w.lead AS llead, w.country_of_sale AS lcountry,
         w.sale_region AS lregion, w.report_state AS lstate,
         a.loan_id AS aid, a.customer_id AS acustomer, a.benchmark_date AS aday,
         a.daily_rate AS arate, a.in_repayment AS arep, a.days_elapsed AS ael,
         s.product_type AS sproduct, s.associator_manager_name AS slead,
         s.country_of_sale AS scountry, s.sale_region AS sregion,
         s.loan_duration + s.introductory_period AS term,
         y.payment_date, y.amount_paid, g.loan_state AS gstate, c.cancellation_reason,
         r.loan_contract_end_date AS rend, r.loan_state AS rstate
  FROM m_ranked AS w
  JOIN cal ON cal.period = w.period AND w.newest = 1
  LEFT JOIN metered_days AS a ON a.loan_id = w.loan_id AND a.benchmark_date = cal.day
  LEFT JOIN sale AS s ON s.loan_id = a.loan_id AND s.account_id = a.account_id
    AND a.days_elapsed > s.introductory_period
  LEFT JOIN paid AS y ON y.period = w.period AND y.payment_date = cal.day
    AND y.loan_id = CASE WHEN w.period = 'current month' THEN w.loan_id ELSE a.loan_id END
  LEFT JOIN metered_loans AS g ON g.loan_id = w.loan_id AND w.period = 'current month'
  LEFT JOIN metered_cancellations AS c ON c.loan_id = a.loan_id
    AND CAST(c.change_recorded_at_utc AS DATE) = a.benchmark_date
  LEFT JOIN metered_finance_monthly AS r ON r.loan_id = a.loan_id
    AND r.report_date = CAST(date_trunc('month', a.benchmark_date) AS DATE) - 1
),
metered_out AS (
  SELECT 'fenix' AS company, period, day AS report_date, day AS generated_date,
    rend AS loan_contract_end_date, lend AS new_loan_contract_end, aday AS benchmark_date,
    coalesce(aid, lid) AS loan_id, coalesce(acustomer, lcustomer) AS customer_id,
    CAST(coalesce(arate, lrate) AS DOUBLE) AS daily_rate,
    CASE period WHEN 'current month' THEN gstate ELSE rstate END AS loan_state,
    CASE period WHEN 'current month' THEN gstate ELSE lstate END AS new_loan_state,
    arep AS in_repayment, lrep AS latest_in_repayment, cancellation_reason,
    coalesce(sproduct, lproduct) AS product, coalesce(slead, llead) AS team_lead,
    coalesce(scountry, lcountry) AS country, coalesce(sregion, lregion) AS region,
    payment_date, amount_paid,
    CASE WHEN lend > coalesce(aday, day) THEN CAST(coalesce(arate, lrate) AS DOUBLE)
         WHEN coalesce(arep, lrep) THEN sum(CASE WHEN coalesce(ael, lel) <= term
              THEN CAST(coalesce(arate, lrate) AS DOUBLE) ELSE 0 END)
         ELSE 0 END AS expected_all_mtd,
    CASE WHEN arep THEN sum(CASE WHEN ael <= term THEN CAST(arate AS DOUBLE) ELSE 0 END)
         ELSE 0 END AS expected_in_month_in_repayment
  FROM m_rows
  GROUP BY period, day, rend, lend, aday, aid, lid, acustomer, lcustomer, arate, lrate, gstate,
    rstate, lstate, arep, lrep, cancellation_reason, sproduct, lproduct, slead, llead, scountry,
    lcountry, sregion, lregion, payment_date, amount_paid
)"""

# title case after a blank or a hyphen, which is all the hub names have
HUB = ("array_to_string(list_transform(string_split(lower(trim(split_part(hub_name, '(', 1))), '-'),"
       " lambda w: upper(w[1]) || w[2:]), '-')")

SNAPSHOT_ARM = f"""
hub AS (
  SELECT c.sales_case_id, c.hub_name, l.region AS hub_region
  FROM sales_cases AS c LEFT JOIN locations AS l ON l.location = {HUB}
),
d_rows AS (
  SELECT p.period, x.snapshot_at AS day, x.loan_account_id, x.customer_id, x.state,
         x.months_on_book AS mob, x.terminated_at, a.loan_contract_end_date, a.loan_type,
         a.cancel_comment, a.installment_periods AS periods,
         CAST(a.initial_installment AS DOUBLE) / 100 AS inst,
         coalesce(i.loan_duration, a.installment_periods * a.installment_period_days) AS dur,
         CAST(i.daily_rate AS DOUBLE) / 100 AS item_rate,
         coalesce(CAST(i.daily_rate AS DOUBLE) / 100,
                  CAST(a.initial_installment AS DOUBLE) / 100
                    / nullif(a.installment_period_days, 0)) AS raw_rate,
         i.down_payment_days AS dpd, i.product_line_name, c.country, m.manager_name,
         x.snapshot_at - CAST(a.handover_at_utc AS DATE) AS el, day(x.snapshot_at) AS dom,
         CAST(a.handover_at_utc AS DATE) AS handover,
         CASE WHEN p.period = 'current month' THEN h.hub_region ELSE c.area1 END AS region,
         y.payment_date, y.amount_paid
  FROM snapshot_days AS x
  JOIN period AS p ON x.snapshot_at BETWEEN p.day_from AND p.day_to
  JOIN loan_accounts AS a ON a.loan_account_id = x.loan_account_id
    AND a.initial_installment > 0 AND a.initial_amount > 0
  JOIN customers AS c ON c.customer_id = x.customer_id AND c.country = 'UG'
  LEFT JOIN paid AS y ON y.period = p.period AND y.loan_id = x.loan_account_id
    AND y.payment_date = x.snapshot_at
  LEFT JOIN agent_managers AS m ON m.sales_agent_id = c.assigned_to_contractor_id
    AND m.benchmark_date = x.snapshot_at
  LEFT JOIN order_items AS i ON i.loan_account_id = x.loan_account_id
    AND i.customer_id = x.customer_id AND i.master_loan_item = 1 AND i.account_type = 'CREDIT'
  LEFT JOIN hub AS h ON h.sales_case_id = i.sales_case_id AND p.period = 'current month'
),
d_rates AS (
  SELECT *, round(raw_rate) AS rate, dpd AS intro,
    round(CASE WHEN loan_type = 'paygo' AND handover <= DATE '2022-04-14' THEN inst / 30.5
               WHEN loan_type = 'paygo' THEN inst
               WHEN loan_type = 'arrears' THEN item_rate
               ELSE inst / 30.5 END) AS rep_rate
  FROM d_rows
),
d_due AS (
  SELECT *,
    CASE WHEN state IN ('rescheduled', 'canceled', 'paid_off') THEN 0
         WHEN loan_type = 'paygo' AND el < intro THEN 0
         WHEN loan_type = 'paygo' AND el - intro <= dom THEN rate
         WHEN loan_type = 'paygo' AND el + intro > dur + dom THEN 0
         WHEN loan_type = 'paygo' THEN rate
         WHEN mob < 2 OR mob - 2 > periods THEN 0
         ELSE round(coalesce(raw_rate, inst / 30.5)) END AS due_all,
    CASE WHEN state IN ('rescheduled', 'canceled') OR terminated_at IS NOT NULL THEN 0
         WHEN loan_type = 'paygo' AND el < intro THEN 0
         WHEN loan_type = 'paygo' AND el - intro <= dom THEN (el - intro) * rep_rate
         WHEN loan_type = 'paygo' AND el + intro > dur + dom THEN 0
         WHEN loan_type = 'paygo' THEN rep_rate
         WHEN mob < 2 OR mob - 2 > periods THEN 0
         ELSE coalesce(rep_rate, inst / 30.5) END AS due_rep
  FROM d_rates
),
snapshot_out AS (
  SELECT 'paygee' AS company, period, day AS report_date, day AS generated_date,
    loan_contract_end_date, loan_contract_end_date AS new_loan_contract_end,
    day AS benchmark_date, loan_account_id AS loan_id, customer_id, rate AS daily_rate,
    lower(state) AS loan_state, lower(state) AS new_loan_state, TRUE AS in_repayment,
    TRUE AS latest_in_repayment, cancel_comment AS cancellation_reason,
    product_line_name AS product, manager_name AS team_lead, country, region, payment_date,
    amount_paid, CAST(sum(due_all) AS DOUBLE) AS expected_all_mtd,
    CAST(sum(due_rep) AS DOUBLE) AS expected_in_month_in_repayment
  FROM d_due
  GROUP BY period, day, loan_contract_end_date, loan_account_id, customer_id, rate, lower(state),
    cancel_comment, product_line_name, manager_name, country, region, payment_date, amount_paid
)"""

BENCHMARK_ARM = """
sold AS (
  SELECT a.loan_account_id, a.customer_id, a.cancel_comment, i.product_line_name, i.sales_case_id,
         i.loan_duration + i.down_payment_days AS term
  FROM loan_accounts AS a LEFT JOIN order_items AS i
    ON i.sales_case_id = a.sales_case_id AND i.loan_account_id = a.loan_account_id
  WHERE a.source = 'alms'
),
b_ranked AS (
  SELECT p.period, x.*, r.loan_contract_end_date AS cend, s.product_line_name AS product,
         m.manager_name, c.country, c.area1,
         row_number() OVER (PARTITION BY p.period, x.loan_id
           ORDER BY x.benchmark_date DESC NULLS FIRST) AS newest
  FROM benchmark_days AS x
  JOIN period AS p ON x.benchmark_date BETWEEN p.back_from AND p.day_to
  LEFT JOIN benchmark_finance_monthly AS r ON r.loan_id = x.loan_id
    AND r.report_date = CAST(date_trunc('month', x.benchmark_date) AS DATE) - 1
  LEFT JOIN sold AS s ON s.loan_account_id = x.loan_id AND s.customer_id = x.customer_id
  LEFT JOIN customers AS c ON c.customer_id = x.customer_id
  LEFT JOIN agent_managers AS m ON m.sales_agent_id = c.assigned_to_contractor_id
    AND m.benchmark_date = x.benchmark_date
  WHERE c.country = 'UG'
),
b_rows AS (
  SELECT w.period, cal.day, w.cend AS lend, CAST(w.daily_rate AS DOUBLE) / 100 AS lrate,
         w.loan_state AS lstate, w.days_elapsed AS lel, w.product AS lproduct,
         w.manager_name AS llead, w.country AS lcountry, w.area1 AS lregion,
         a.loan_id, a.customer_id, a.benchmark_date AS aday, a.loan_state AS astate,
         CAST(a.daily_rate AS DOUBLE) / 100 AS arate, a.days_elapsed AS ael,
         s.product_line_name AS sproduct, s.cancel_comment, s.term, m.manager_name AS slead,
         c.country AS scountry, r.loan_contract_end_date AS rend, y.payment_date, y.amount_paid,
         CASE WHEN c.country = 'UG' AND w.period = 'last month' THEN h.hub_region
              WHEN c.country IN ('MZ', 'CI') THEN c.area2 ELSE c.area1 END AS sregion
  FROM b_ranked AS w
  JOIN cal ON cal.period = w.period AND w.newest = 1
  LEFT JOIN benchmark_days AS a ON a.loan_id = w.loan_id AND a.benchmark_date = cal.day
  LEFT JOIN sold AS s ON s.loan_account_id = a.loan_id AND s.customer_id = a.customer_id
  LEFT JOIN customers AS c ON c.customer_id = a.customer_id
  LEFT JOIN agent_managers AS m ON m.sales_agent_id = c.assigned_to_contractor_id
    AND m.benchmark_date = a.benchmark_date
  LEFT JOIN benchmark_finance_monthly AS r ON r.loan_id = a.loan_id
    AND r.report_date = CAST(date_trunc('month', a.benchmark_date) AS DATE) - 1
  LEFT JOIN hub AS h ON h.sales_case_id = s.sales_case_id AND w.period = 'last month'
  LEFT JOIN paid AS y ON y.period = w.period AND y.loan_id = a.loan_id
    AND y.payment_date = a.benchmark_date
),
b_keyed AS (
  SELECT *, coalesce(arate, lrate) AS rate, coalesce(astate, lstate) AS state_now,
         coalesce(sproduct, lproduct) AS product, coalesce(slead, llead) AS team_lead,
         coalesce(scountry, lcountry) AS country, coalesce(sregion, lregion) AS region
  FROM b_rows
),
benchmark_out AS (
  SELECT 'alms' AS company, period, day AS report_date, day AS generated_date,
    rend AS loan_contract_end_date, lend AS new_loan_contract_end, aday AS benchmark_date,
    loan_id, customer_id, rate AS daily_rate, astate AS loan_state, lstate AS new_loan_state,
    TRUE AS in_repayment, TRUE AS latest_in_repayment, cancel_comment AS cancellation_reason,
    product, team_lead, country, region, payment_date, amount_paid,
    CASE WHEN lend > coalesce(aday, day) THEN rate
         WHEN state_now = 'repayment'
           THEN sum(CASE WHEN coalesce(ael, lel) <= term THEN rate ELSE 0 END)
         ELSE 0 END AS expected_all_mtd,
    CASE WHEN astate = 'repayment' THEN sum(CASE WHEN ael <= term THEN arate ELSE 0 END)
         ELSE 0 END AS expected_in_month_in_repayment
  FROM b_keyed
  GROUP BY period, day, rend, lend, aday, loan_id, customer_id, rate, astate, lstate, state_now,
    cancel_comment, product, team_lead, country, region, payment_date, amount_paid
)"""

COUNTRY_OF_CODE = """CASE {c} WHEN 'BJ' THEN 'Benin' WHEN 'CI' THEN 'Côte d''Ivoire'
  WHEN 'KE' THEN 'Kenya' WHEN 'MZ' THEN 'Mozambique' WHEN 'NG' THEN 'Nigeria'
  WHEN 'RW' THEN 'Rwanda' WHEN 'TZ' THEN 'Tanzania' WHEN 'UG' THEN 'Uganda'
  WHEN 'ZM' THEN 'Zambia' ELSE {c} END"""

SENDER = "CASE WHEN sender[1] = '+' THEN sender ELSE '+' || sender END"

PAYERS = f"""
sale_one AS (SELECT * FROM metered_sales WHERE sales_order_count = 1),
payer_ranked AS (
  SELECT o.primary_phone AS user_phone, o.secondary_phones AS user_secondary_phone,
         o.alternate_contacts AS alternate_phone, {SENDER} AS sender_phone,
         w.person_id AS sender_id, w.first_name || ' ' || w.last_name AS sender_name,
         w.fenixdb_user_id AS sender_fenixdb_user, x.account_id AS sender_customer,
         e.associator_name AS associate_name, f.primary_phone AS associate_phone,
         row_number() OVER (PARTITION BY w.person_id
           ORDER BY CAST(v.start_date_utc AS DATE) NULLS LAST, x.account_id, x.payment_id) AS rn
  FROM metered_account_transactions AS x
  LEFT JOIN payments AS y ON y.id = x.payment_id
  LEFT JOIN metered_accounts AS a ON a.account_id = x.account_id
  LEFT JOIN persons AS o ON o.person_id = a.user_id
  LEFT JOIN persons AS w ON w.primary_phone = {SENDER}
  LEFT JOIN sale_one AS v ON v.customer_id = w.person_id
  LEFT JOIN sale_one AS e ON e.account_id = x.account_id
  LEFT JOIN persons AS f ON f.person_id = e.associator_id
  WHERE x.transaction_type_id IN (2, 4) AND x.payment_id IS NOT NULL
),
payer AS (SELECT * EXCLUDE (rn) FROM payer_ranked WHERE rn = 1)"""

_DUE = """q.first_payment_due, q.first_payment_due AS daily_first_payment_due_date,
    q.first_payment_due_monthly AS monthly_first_payment_due_date, q.first_payment_due_w_grace,
    q.first_payment_due_monthly_w_grace, q.missed_first_payment AS late_dummy,
    q.missed_first_payment AS late_dummy_daily,
    q.missed_first_payment_monthly AS late_dummy_monthly,
    q.days_issued_sale_date AS days_issued_day_0"""


def _account_profile(snapshot: bool) -> str:
    def cents(column: str) -> str:
        return f"CAST({column} AS DOUBLE) / 100"

    def rw(mapped: str, own: str) -> str:
        if not snapshot:
            return own
        return f"CASE WHEN c.country = 'RW' THEN coalesce({mapped}, {own}) ELSE {own} END"

    overdue = "CASE WHEN a.days_til_lockout < 0 THEN -a.days_til_lockout ELSE 0 END"
    zone = """CASE c.country WHEN 'TZ' THEN am.region WHEN 'KE' THEN sp.region
      WHEN 'UG' THEN h.hub_region ELSE c.area1 END"""
    lead = rw("g.coordinator_name", "c.application_coordinator_name")
    if snapshot:
        lead = f"CASE WHEN c.country = 'TZ' THEN am.manager ELSE {lead} END"
        who, table = "a.customer_id", "best_loan"
        location = "CASE WHEN c.country = 'RW' THEN g.region ELSE c.area1 END"
        remaining = [cents("a.amount_remaining")] * 2
        totals = ["0.0", cents("(a.loan_amount - i.down_payment)")]
        expected = cents("a.amount_expected_minus_down_payment")
    else:
        lead, table, location = "c.application_by_contractor_name", "loan_accounts", "c.area1"
        principal = cents("a.remaining_principal")
        remaining = [f"{principal} + {cents('a.remaining_interest_accrued')}",
                     f"{principal} + {cents('a.remaining_interest_total')}"]
        totals = [cents("i.total_interest"), cents("i.principal_price")]
        expected = f"{cents('a.expected_interest')} + {cents('a.expected_principal')}"
    return f"""
  SELECT a.loan_type, {'a.customer_id' if snapshot else 'q.account_id'} AS account_id,
    {'a.customer_id' if snapshot else 'q.customer_id'} AS customer_id, n.name AS country,
    CAST(a.handover_at_utc AS DATE) AS account_start_date, a.days_locked, a.percent_locked,
    a.days_til_lockout, a.days_locked, {'a.state' if snapshot else 'lower(a.state)'}, {_DUE},
    {location}, h.hub_name, i.fenix_product_category, i.product_name,
    i.product_name || ' _ ' || CAST(trunc({cents('i.down_payment')}) AS BIGINT) || 'dp _ '
      || i.payment_plan, pm.product_group_name, pm.wattage || 'W', {cents('i.down_payment')},
    i.loan_duration, {cents('i.daily_rate')},
    {rw('g.sales_agent_id', 'c.application_by_contractor_id')},
    c.application_by_contractor_role,
    {rw('g.sales_agent', 'c.application_by_contractor_name')},
    {rw('g.coordinator_id', 'c.application_coordinator_id')}, {lead},
    c.application_coordinator_role, {zone},
    CASE WHEN c.country = 'RW' THEN coalesce(g.region, c.area1) ELSE {zone} END,
    CASE c.country WHEN 'TZ' THEN h.hub_name WHEN 'KE' THEN sp.subcounty ELSE c.area3 END,
    c.area2, {'NULL' if snapshot else 'c.area4'}, c.occupation, c.gender,
    CASE WHEN k.birthdate < DATE '2024-03-31' THEN 2024 - year(k.birthdate) END,
    k.customer_name, k.primary_phone_number, k.other_phone_numbers, c.spoken_language,
    c.reading_language, i.sales_case_rank, i.down_payment_days, a.installment_periods,
    {cents('a.initial_installment')},
    CAST(coalesce(a.defaulted_at_utc, a.canceled_at_utc, a.rescheduled_at_utc) AS DATE),
    CAST(a.paid_off_at_utc AS DATE),
    CASE WHEN i.product_name LIKE 'Cooperative%' THEN 1 ELSE 0 END,
    {'a.par_days' if snapshot else overdue}, '{'Mobisol' if snapshot else 'Alms'}',
    a.cancel_comment, {remaining[0]}, {remaining[1]}, {totals[0]}, {totals[1]},
    {cents('a.amount_paid_minus_down_payment')}, {expected},
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM {table} AS a
  RIGHT JOIN first_payments AS q ON q.customer_id = a.customer_id
    AND q.loan_id = a.loan_account_id
  LEFT JOIN order_items AS i ON i.loan_account_id = a.loan_account_id
    AND i.fenix_product_category = 'ReadyPay' AND i.product_line_segment_name = 'ReadyPay'
    AND i.master_loan_item = 1 AND i.sales_case_rank = 1 AND i.account_type = 'CREDIT'
  LEFT JOIN customer_contacts AS k ON k.customer_id = a.customer_id
  LEFT JOIN customers AS c ON c.customer_id = a.customer_id
  LEFT JOIN country_names AS n ON n.iso_2_abbreviation = c.country
  LEFT JOIN hub AS h ON h.sales_case_id = {'i' if snapshot else 'a'}.sales_case_id
  LEFT JOIN agent_mapping AS g ON g.sales_agent_id = c.application_by_contractor_id
  LEFT JOIN product_mapping AS pm ON pm.product_type = trim(i.product_name)
  LEFT JOIN area_manager AS am ON am.area2 = c.area2
  LEFT JOIN hub_stock_point AS sp ON sp.hub_id = c.hub_id
  WHERE CAST(a.handover_at_utc AS DATE) >= DATE '2018-01-01' AND c.country IS NOT NULL
    AND i.account_type = 'CREDIT' AND a.source = '{'admin' if snapshot else 'alms'}'
    {"AND i.installment_amount > 0 AND (i.product_name IS NULL OR i.product_name NOT LIKE '%COVID%')"
     if snapshot else ''}"""


BEST_LOAN = """
best_loan AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT a.*, row_number() OVER (PARTITION BY a.customer_id
      ORDER BY i.down_payment DESC NULLS FIRST, a.loan_account_id DESC) AS rn
    FROM loan_accounts AS a LEFT JOIN order_items AS i ON i.loan_account_id = a.loan_account_id
    WHERE i.master_loan_item = 1 AND i.account_type = 'CREDIT') AS z
  WHERE rn = 1
)"""

HUB_ONLY = SNAPSHOT_ARM[: SNAPSHOT_ARM.index("d_rows AS")].rstrip().rstrip(",")

PROFILE = f"""WITH {PAYERS.strip()},
{BEST_LOAN.strip()},
{HUB_ONLY.strip()}
  SELECT 'paygo' AS loan_type, a.account_id, a.customer_id, a.country, a.account_start_date,
    a.account_days_locked, a.account_percent_locked, a.account_days_til_lockout,
    a.account_max_consecutive_days_locked, a.account_state, {_DUE}, s.associator_location,
    s.sale_location, s.product_category, s.product_type, s.payment_plan, pm.product_group_name,
    pm.wattage || 'W' AS system_size, CAST(s.deposit_amount AS DOUBLE) AS deposit_amount,
    s.loan_duration, CAST(s.daily_rate AS DOUBLE) AS daily_rate,
    s.associator_id || 'f' AS associator_id, s.associator_role, s.associator_name,
    s.associator_manager_id || 'f' AS associator_manager_id, s.associator_manager_name,
    s.manager_role, d.region AS zone,
    CASE WHEN s.country_of_sale = 'Uganda' THEN l.region ELSE d.region END AS region,
    d.subcounty, d.district, d.parish, d.occupation, d.gender, d.age,
    o.first_name || ' ' || o.last_name AS customer_name, o.primary_phone AS primary_phone_number,
    o.secondary_phones AS secondary_phone_number, d.primary_language, d.messaging_language,
    s.sales_order_count, s.introductory_period, s.loan_duration // 30 AS installment_periods,
    CAST(s.daily_rate * 30 AS DOUBLE) AS initial_installment,
    CAST(g.cancellation_date_utc AS DATE) AS cancellation_date_utc,
    CAST(g.payoff_date_utc AS DATE) AS payoff_date_utc, 0 AS coop_loan,
    CASE WHEN g.prepaid_days_remaining < 0 THEN -g.prepaid_days_remaining ELSE 0 END AS par_days,
    'Fenix' AS company, g.cancellation_reason,
    CAST(g.amount_remaining_interest_accrued_to_date AS DOUBLE)
      AS amount_remaining_interest_accrued_to_date,
    CAST(g.amount_remaining_all_interest AS DOUBLE) AS amount_remaining_all_interest,
    CAST(s.total_interest AS DOUBLE) AS total_interest,
    CAST(s.total_principal AS DOUBLE) AS total_principal,
    CAST(g.paid_principal + g.paid_interest AS DOUBLE) AS amount_paid,
    CAST(g.amount_expected AS DOUBLE) AS expected_amount, y.user_phone, y.user_secondary_phone,
    y.alternate_phone, o.alternate_contacts, y.sender_phone, y.sender_id, y.sender_name,
    y.sender_fenixdb_user, y.associate_name, y.associate_phone
  FROM metered_accounts AS a
  LEFT JOIN first_payments AS q ON q.account_id = a.account_id
  LEFT JOIN sale_one AS s ON s.account_id = a.account_id
  LEFT JOIN product_mapping AS pm ON pm.product_type = s.product_type
  LEFT JOIN person_demographics AS d ON d.person_id = s.customer_id
  LEFT JOIN persons AS o ON o.person_id = s.customer_id_fenixdb
  LEFT JOIN metered_loans AS g ON g.account_id = a.account_id AND g.loan_id = s.loan_id
  LEFT JOIN payer AS y ON y.sender_customer = a.account_id
  LEFT JOIN locations AS l ON l.location = coalesce(s.sale_location, s.associator_location)
  WHERE s.country_of_sale NOT LIKE '%Senegal%'
UNION
{_account_profile(True)}
UNION
{_account_profile(False)}"""

# Zambia and its neighbours keep one offset all year
_OFFSET = """CASE {c} WHEN 'UG' THEN 3 WHEN 'KE' THEN 3 WHEN 'TZ' THEN 3 WHEN 'ZM' THEN 2
  WHEN 'RW' THEN 2 WHEN 'MZ' THEN 2 WHEN 'BJ' THEN 1 WHEN 'NG' THEN 1 WHEN 'CI' THEN 0 END"""


def _local(ts: str, country: str) -> str:
    return f"CAST({ts} + ({_OFFSET.format(c=country)}) * INTERVAL 1 HOUR AS DATE)"


PROFILE_COLUMNS = """z.customer_id, k.customer_name, k.primary_phone_number,
    coalesce(k.other_phone_numbers, '') AS other_phone_numbers"""
AGENT_COLUMNS = """coalesce(z.adopted_by_contractor_id, z.application_by_contractor_id,
      z.assigned_to_contractor_id) AS assigned_to_agent_id,
    coalesce(o.name || ' ' || o.surname, z.application_by_contractor_name,
      z.assigned_to_contractor_name) AS assigned_to_agent_name"""
CUSTOMER_JOINS = """
  LEFT JOIN contractors AS o ON o.contractor_id = z.adopted_by_contractor_id
  LEFT JOIN customer_contacts AS k ON k.customer_id = z.customer_id
  LEFT JOIN location_areas AS ar ON ar.location_area_id = k.location_area_id"""
RANKED = "row_number() OVER (PARTITION BY loan_id, month_end ORDER BY frequency DESC, trans_amount NULLS LAST"


def _segment(watt: str, product: str) -> str:
    return (f"CASE WHEN {watt} BETWEEN 80 AND 200 THEN 'High end' "
            f"WHEN {watt} BETWEEN 21 AND 79 OR contains({product}, 'TV') THEN 'Medium' "
            f"WHEN {watt} <= 20 THEN 'Entry Level' ELSE 'EXCEPTION' END")


_FIN = """CAST(coalesce(r.paid_in_month, f.paid_in_month) AS DOUBLE) AS paid_mtd,
    CAST(coalesce(r.expected_in_month_ongoing, f.expected_in_month_ongoing) AS DOUBLE)
      AS expected_ongoing_mtd,
    CAST(coalesce(r.expected_in_month_total, f.expected_in_month_total) AS DOUBLE)
      AS expected_mtd"""

_SCHEDULE_TERMS = """coalesce(m.state, d.state) AS state,
    coalesce(m.snapshot_at, d.snapshot_at) - CAST(a.handover_at_utc AS DATE) AS el,
    day(coalesce(m.snapshot_at, d.snapshot_at)) AS dom,
    coalesce(m.months_on_book, d.months_on_book) AS mob,
    coalesce(m.terminated_at, d.terminated_at) AS terminated, a.loan_type AS kind,
    a.loan_duration AS dur, i.down_payment_days AS intro, a.installment_periods AS periods,
    CAST(a.daily_rate AS DOUBLE) / 100 AS rate,
    coalesce(CAST(a.daily_rate AS DOUBLE) / 100, CAST(a.initial_installment AS DOUBLE) / 100
      / nullif(a.installment_period_days, 0)) AS any_rate"""
_EXPECTED = """CASE WHEN state = 'rescheduled' OR state = 'paid_off' THEN 0
      WHEN ctry <> 'KE' AND kind <> 'paygo' AND state = 'canceled' THEN 0
      WHEN kind = 'paygo' AND el < intro THEN 0
      WHEN kind = 'paygo' AND el - intro <= dom THEN (el - intro) * rate
      WHEN kind = 'paygo' AND el + intro > dur + dom THEN 0
      WHEN kind = 'paygo' AND el + intro > dur THEN (dom - el - dur + intro) * rate
      WHEN kind = 'paygo' THEN rate * dom
      WHEN mob < 2 OR mob - 2 > periods THEN 0 ELSE any_rate * dom END"""
_ONGOING = """CASE WHEN state IN ('rescheduled', 'canceled') OR terminated IS NOT NULL THEN 0
      WHEN kind = 'paygo' AND el < intro THEN 0
      WHEN kind = 'paygo' AND el <= dur + intro THEN rate WHEN kind = 'paygo' THEN NULL
      WHEN mob < 2 OR mob - 2 > periods THEN 0 ELSE rate * dom END"""

USUAL = f"""
u_metered AS (
  SELECT 'paygo' AS loan_type, t.loan_id,
    coalesce(CAST(r.months_since_loan_start AS VARCHAR), '') AS months_since_loan_start,
    {PROFILE_COLUMNS}, coalesce(d.region, ar.area1, '') AS region,
    coalesce(d.district, ar.area2, '') AS district,
    coalesce(d.parish, ar.area3, ar.area4, '') AS parish,
    coalesce(p.landmark, k.address || ',' || k.directions, '') AS direction, {AGENT_COLUMNS},
    pm.product_group_name AS product,
    {_segment('pm.wattage', 'f.product_type')} AS product_segmentation, {_FIN},
    last_day({_local('t.added_at_utc', 't.country')}) AS month_end,
    round(CAST(t.portion_interest + t.portion_principal AS DOUBLE)) AS trans_amount,
    CAST(f.daily_rate AS DOUBLE) AS daily_rate
  FROM metered_transactions AS t
  LEFT JOIN metered_finance_daily AS f ON f.loan_id = t.loan_id
  LEFT JOIN product_mapping AS pm ON pm.product_type = f.product_type
  LEFT JOIN metered_finance_monthly AS r ON r.loan_id = t.loan_id
    AND r.report_date = last_day({_local('t.added_at_utc', 't.country')})
  LEFT JOIN customers AS z ON z.customer_id = f.customer_id
  {CUSTOMER_JOINS}
  LEFT JOIN persons AS p ON p.person_id = f.customer_id_fenixdb
  LEFT JOIN person_demographics AS d ON d.person_id = f.customer_id_fenixdb
  WHERE t.transaction_type_id IN (2, 18, 20, 24, 61) AND t.country = 'ZM'
    AND {_local('t.added_at_utc', 't.country')} > DATE '2023-12-31'
),
u_benchmark AS (
  SELECT 'paygo' AS loan_type, t.loan_id,
    CAST(r.months_since_loan_start AS VARCHAR) AS months_since_loan_start, {PROFILE_COLUMNS},
    coalesce(ar.area1, '') AS region, coalesce(ar.area2, '') AS district,
    coalesce(ar.area3, ar.area4, '') AS parish,
    coalesce(k.address || ',' || k.directions, '') AS direction, {AGENT_COLUMNS},
    pm.product_group_name AS product,
    {_segment('pm.wattage', 'f.product_type')} AS product_segmentation, {_FIN},
    last_day({_local('t.added_at_utc', 'i.country')}) AS month_end,
    round(CAST(t.portion_interest + t.portion_principal AS DOUBLE) / 100) AS trans_amount,
    CAST(f.daily_rate AS DOUBLE) AS daily_rate, t.id
  FROM benchmark_transactions AS t
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = t.loan_id
  LEFT JOIN benchmark_finance_daily AS f ON f.loan_id = t.loan_id
  LEFT JOIN order_items AS i ON i.sales_case_id = a.sales_case_id
  LEFT JOIN product_mapping AS pm ON pm.product_type = f.product_type
  LEFT JOIN benchmark_finance_monthly AS r ON r.loan_id = t.loan_id
    AND r.report_date = last_day({_local('t.added_at_utc', 'i.country')})
  LEFT JOIN customers AS z ON z.customer_id = f.customer_id
  {CUSTOMER_JOINS}
  WHERE t.transaction_type IN ('Loan Payment', 'Loan Transaction Reversal')
    AND i.country = 'ZM' AND {_local('t.added_at_utc', 'i.country')} > DATE '2023-12-31'
),
u_booked AS (
  SELECT 'arrears' AS loan_type, t.loan_account_id AS loan_id,
    CAST(m.months_on_book AS VARCHAR) AS months_since_loan_start, {PROFILE_COLUMNS},
    coalesce(ar.area1, '') AS region, coalesce(ar.area2, '') AS district,
    coalesce(ar.area3, ar.area4, '') AS parish,
    coalesce(k.address || ',' || k.directions, '') AS direction, {AGENT_COLUMNS},
    pm.product_group_name AS product,
    {_segment('pm.wattage', 'i.product_name')} AS product_segmentation,
    CAST(m.outstanding_amount AS DOUBLE) / 100 - CAST(d.outstanding_amount AS DOUBLE) / 100
      AS paid_mtd,
    last_day({_local('t.transaction_at', 'i.country')}) AS month_end,
    round(CAST(t.amount AS DOUBLE) / 100) AS trans_amount, z.country AS ctry, {_SCHEDULE_TERMS}
  FROM payment_bookings AS t
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = t.loan_account_id
  LEFT JOIN order_items AS i ON i.sales_case_id = a.sales_case_id
    AND i.loan_account_id = t.loan_account_id
  LEFT JOIN product_mapping AS pm ON pm.product_type = trim(i.product_name)
  LEFT JOIN snapshot_days AS d ON d.loan_account_id = t.loan_account_id
    AND d.snapshot_at = last_day({_local('t.transaction_at', 'i.country')})
  LEFT JOIN snapshot_days AS m ON m.loan_account_id = t.loan_account_id
    AND m.snapshot_at = d.snapshot_prev_month
  LEFT JOIN customers AS z ON z.customer_id = d.customer_id
  {CUSTOMER_JOINS}
  WHERE t.transaction_type IN ('PaymentChargeTransaction', 'RescueChargeTransaction')
    AND i.country = 'ZM' AND {_local('t.transaction_at', 'i.country')} > DATE '2023-12-31'
),
u_counted AS (
  SELECT 1 AS arm, *, round(trans_amount / nullif(daily_rate, 0)) AS lighting_days_paid_for,
         count(*) AS frequency
  FROM u_metered GROUP BY ALL
  UNION ALL
  SELECT 2, * EXCLUDE (id), round(trans_amount / nullif(daily_rate, 0)),
         count(DISTINCT id) FROM u_benchmark GROUP BY ALL
  UNION ALL
  SELECT 3, * EXCLUDE (rate), round(trans_amount / nullif(rate, 0)), count(*)
  FROM (
    SELECT loan_type, loan_id, months_since_loan_start, customer_id, customer_name,
      primary_phone_number, other_phone_numbers, region, district, parish, direction,
      assigned_to_agent_id, assigned_to_agent_name, product, product_segmentation, paid_mtd,
      {_EXPECTED} AS expected_first, {_ONGOING} AS expected_second, month_end, trans_amount,
      round(rate) AS daily_rate, rate
    FROM u_booked) AS b
  GROUP BY ALL
),
usual AS (
  SELECT * EXCLUDE (arm, rn), CAST(1 AS BIGINT) AS count_loans FROM (
    SELECT *, row_number() OVER (PARTITION BY arm, loan_id, month_end
      ORDER BY frequency DESC, trans_amount NULLS LAST, loan_type,
        months_since_loan_start NULLS FIRST, customer_id NULLS FIRST, customer_name NULLS FIRST,
        primary_phone_number NULLS FIRST, other_phone_numbers, region, district, parish,
        direction, assigned_to_agent_id NULLS FIRST, assigned_to_agent_name NULLS FIRST,
        product NULLS FIRST, product_segmentation, paid_mtd NULLS FIRST,
        expected_ongoing_mtd NULLS FIRST, expected_mtd NULLS FIRST, daily_rate NULLS FIRST) AS rn
    FROM u_counted) AS x
  WHERE rn = 1
)"""

STATISTICS = f"""
statistics AS (
  SELECT t.loan_id, last_day({_local('t.added_at_utc', 't.country')}) AS month_end,
    count(t.id) AS total_transactions,
    CAST(max(t.portion_interest + t.portion_principal) AS DOUBLE) AS max_payment,
    CAST(min(t.portion_interest + t.portion_principal) AS DOUBLE) AS min_payment,
    round(CAST(sum(t.portion_interest + t.portion_principal) AS DOUBLE) / count(*))
      AS avg_payment
  FROM metered_transactions AS t
  WHERE t.transaction_type_id IN (2, 18, 20, 24, 61) AND t.country = 'ZM'
  GROUP BY 1, 2
  UNION
  SELECT t.loan_id, last_day({_local('t.added_at_utc', 'i.country')}), count(t.id),
    CAST(max(t.portion_interest + t.portion_principal) AS DOUBLE) / 100,
    CAST(min(t.portion_interest + t.portion_principal) AS DOUBLE) / 100,
    round(CAST(sum(t.portion_interest + t.portion_principal) AS DOUBLE) / 100 / count(*))
  FROM benchmark_transactions AS t
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = t.loan_id
  LEFT JOIN benchmark_finance_daily AS f ON f.loan_id = t.loan_id
  LEFT JOIN order_items AS i ON i.sales_case_id = a.sales_case_id
  LEFT JOIN benchmark_finance_daily AS f2 ON f2.loan_id = t.loan_id
  WHERE t.transaction_type IN ('Loan Payment', 'Loan Transaction Reversal')
    AND i.country = 'ZM'
  GROUP BY 1, 2
  UNION
  SELECT t.loan_account_id, last_day({_local('t.transaction_at', 'i.country')}),
    count(DISTINCT t.payment_booking_id), CAST(max(t.amount) AS DOUBLE) / 100,
    CAST(min(t.amount) AS DOUBLE) / 100,
    round(CAST(sum(t.amount) AS DOUBLE) / 100 / count(*))
  FROM payment_bookings AS t
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = t.loan_account_id
  LEFT JOIN order_items AS i ON i.sales_case_id = a.sales_case_id
  WHERE t.transaction_type IN ('PaymentChargeTransaction', 'RescueChargeTransaction')
    AND i.country = 'ZM'
  GROUP BY 1, 2
)"""

def _month_profile(after: str, usual_after: str) -> str:
    """Usual amount and statistics of each system's loans and months, from joined rows."""
    value = "t.portion_interest + t.portion_principal"
    metered = """FROM metered_transactions AS t
  WHERE t.transaction_type_id IN (2, 18, 20, 24, 61) AND t.country = 'ZM'"""
    case = "EXISTS (SELECT 1 FROM loan_accounts AS a JOIN order_items AS i USING (sales_case_id) WHERE i.country = 'ZM'"
    benchmark = """FROM benchmark_transactions AS t
  WHERE t.transaction_type IN ('Loan Payment', 'Loan Transaction Reversal')"""
    booked = """FROM payment_bookings AS t
  WHERE t.transaction_type IN ('PaymentChargeTransaction', 'RescueChargeTransaction')"""
    added, booked_on = _local("t.added_at_utc", "'ZM'"), _local("t.transaction_at", "'ZM'")
    return f"""
WITH paid AS (
  SELECT 'metered' AS system, t.loan_id, {added} AS day, CAST(t.id AS VARCHAR) AS id, {value} AS value,
         1.0 AS per, true AS own, 1 AS copies
  {metered}
  UNION ALL
  SELECT 'benchmark', t.loan_id, {added}, CAST(t.id AS VARCHAR), {value}, 100.0, true,
    (SELECT count(*) FROM loan_accounts AS a JOIN order_items AS i USING (sales_case_id)
     WHERE i.country = 'ZM' AND a.loan_account_id = t.loan_id)
    * greatest(1, (SELECT count(*) * count(*) FROM benchmark_finance_daily AS f WHERE f.loan_id = t.loan_id))
  {benchmark} AND {case} AND a.loan_account_id = t.loan_id)
  UNION ALL
  SELECT 'snapshot', t.loan_account_id, {booked_on}, CAST(t.payment_booking_id AS VARCHAR), t.amount, 100.0,
    {case} AND a.loan_account_id = t.loan_account_id AND i.loan_account_id = t.loan_account_id), 1
  {booked} AND {case} AND a.loan_account_id = t.loan_account_id)
), dated AS (
  SELECT *, last_day(day) AS month_end, round(CAST(value AS DOUBLE) / per) AS trans_amount
  FROM paid WHERE day > DATE '{after}'
), totals AS (
  SELECT system, loan_id, month_end,
    CASE WHEN system = 'snapshot' THEN count(DISTINCT id) ELSE CAST(sum(CASE WHEN id IS NOT NULL THEN copies ELSE 0 END) AS BIGINT) END
      AS total_transactions,
    CAST(max(value) AS DOUBLE) / max(per) AS max_payment, CAST(min(value) AS DOUBLE) / max(per) AS min_payment,
    round(CAST(sum(value) AS DOUBLE) / max(per) / count(value)) AS avg_payment
  FROM dated GROUP BY system, loan_id, month_end
), counted AS (
  SELECT system, loan_id, month_end, trans_amount,
    CASE WHEN system = 'benchmark' THEN count(DISTINCT id) ELSE count(*) END AS times
  FROM dated WHERE own AND day > DATE '{usual_after}' GROUP BY system, loan_id, month_end, trans_amount
), best AS (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY system, loan_id, month_end
    ORDER BY times DESC, trans_amount NULLS LAST) = 1
)
SELECT t.system, t.loan_id, t.month_end, b.system IS NOT NULL AS has_usual, b.trans_amount, b.times,
  t.total_transactions, t.max_payment, t.min_payment, t.avg_payment
FROM totals AS t LEFT JOIN best AS b ON b.system = t.system AND b.month_end = t.month_end
  AND b.loan_id IS NOT DISTINCT FROM t.loan_id"""


SPANS = """
span_by_name AS (
  SELECT sa_name, min(day) AS first_sale, max(day) AS last_sale FROM (
    SELECT lower(coalesce(c.application_by_contractor_name, c.assigned_to_contractor_name))
             AS sa_name, CAST(i.handover_at_utc AS DATE) AS day
    FROM loan_accounts AS a
    LEFT JOIN customers AS c ON c.customer_id = a.customer_id
    LEFT JOIN order_items AS i ON i.customer_id = a.customer_id
    WHERE i.account_type = 'CREDIT' AND a.state = 'active' AND i.sale_type = 'FIRST SALE'
      AND i.sales_order_submitted_by_type <> 'User'
    UNION ALL
    SELECT lower(associator_name), CAST(date_fulfilled_utc AS DATE) FROM metered_sales) AS x
  GROUP BY sa_name
),
span_by_id AS (
  SELECT c.application_by_contractor_id AS associator_id,
    min(CAST(i.handover_at_utc AS DATE)) AS first_sale,
    max(CAST(i.handover_at_utc AS DATE)) AS last_sale
  FROM order_items AS i LEFT JOIN customers AS c ON c.customer_id = i.customer_id
  WHERE i.account_type = 'CREDIT' AND i.master_loan_item = 1
  GROUP BY 1
)"""

OWNED = "w.loan_id IS NOT NULL AND w.person_responsible NOT LIKE 'Collection_Champions'"


def _status(day: str, last: str) -> str:
    return (f"CASE WHEN {OWNED} THEN 'non_orphan' WHEN v.customer_id IS NOT NULL THEN 'non_orphan' "
            f"WHEN {last} >= {day} - 60 THEN 'non_orphan' ELSE 'orphan' END AS orphaned_status")


def _known_and_owned(day: str, loan: str) -> str:
    return f"""
  LEFT JOIN (SELECT DISTINCT customer_id, CAST(created_at_utc AS DATE) AS known_on
             FROM reassigned_customers) AS v
    ON v.customer_id = x.customer_id AND v.known_on <= {day}
  LEFT JOIN (SELECT DISTINCT loan_id, person_responsible FROM portfolio_owners) AS w
    ON w.loan_id = {loan}"""


_CHANNEL = """
  LEFT JOIN channel_mapping AS h ON h.order_item_id = i.sales_order_item_id
    AND h.account_id = coalesce(i.loan_portfolio_id, '')
    AND h.loan_id = coalesce(i.loan_account_id, '') AND h.source = 'Solarhub'"""

ORPHANS = f"""WITH {SPANS.strip()}
  SELECT x.report_date, 'fenixdb' AS source, 'paygo' AS loan_type, 'in_repayment' AS loan_state,
    y.iso_3_abbreviation AS country, {_status('x.report_date', 'sp.last_sale')},
    round(x.days_elapsed / CAST(30.5 AS DOUBLE)) AS months_on_book,
    count(DISTINCT x.loan_id) AS count_loan_id,
    count(DISTINCT x.customer_id) AS count_customer_id
  FROM metered_finance_monthly AS x
  {_known_and_owned('x.report_date', 'x.loan_id')}
  LEFT JOIN metered_sales AS s ON s.account_id = x.account_id AND s.loan_id = x.loan_id
  LEFT JOIN span_by_name AS sp ON sp.sa_name = lower(s.associator_name)
  LEFT JOIN countries AS y ON y.name = s.country_of_sale
  WHERE x.active = 'active' AND s.country_of_sale NOT IN ('Senegal', 'Kenya')
    AND x.report_date >= DATE '2023-04-01'
  GROUP BY 1, 2, 3, 4, 5, 6, 7
UNION ALL
  SELECT x.snapshot_at, 'admin', a.loan_type, x.state, y.iso_3_abbreviation,
    {_status('x.snapshot_at', 'coalesce(sp.last_sale, si.last_sale)')},
    CAST(x.months_on_book AS DOUBLE), count(DISTINCT x.loan_account_id),
    count(DISTINCT x.customer_id)
  FROM snapshot_months AS x
  {_known_and_owned('x.snapshot_at', 'x.loan_account_id')}
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = x.loan_account_id
    AND a.customer_id = x.customer_id AND a.last_benchmark_date = x.snapshot_at
  LEFT JOIN order_items AS i ON i.customer_id = x.customer_id
    AND i.loan_account_id = x.loan_account_id
  {_CHANNEL}
  LEFT JOIN countries AS y ON y.iso_2_abbreviation = i.country
  LEFT JOIN customers AS c ON c.customer_id = a.customer_id
  LEFT JOIN span_by_name AS sp
    ON sp.sa_name = coalesce(lower(h.sales_agent_name), lower(c.application_by_contractor_name))
  LEFT JOIN span_by_id AS si ON si.associator_id = c.application_by_contractor_id
  WHERE x.state IN ('maintained', 'exceeded_grace_period', 'exceeded_loan_period',
                    'in_grace_period')
    AND y.iso_2_abbreviation NOT LIKE 'DE' AND x.snapshot_at >= DATE '2023-04-01'
  GROUP BY 1, 2, 3, 4, 5, 6, 7
UNION ALL
  SELECT x.report_date, 'alms', 'paygo', x.loan_state, y.iso_3_abbreviation,
    {_status('x.report_date', 'coalesce(sp.last_sale, si.last_sale)')},
    round(x.days_elapsed / CAST(30.5 AS DOUBLE)), count(DISTINCT x.loan_id),
    count(DISTINCT x.customer_id)
  FROM benchmark_finance_monthly AS x
  {_known_and_owned('x.report_date', 'x.loan_id')}
  LEFT JOIN loan_accounts AS a ON a.loan_account_id = x.loan_id
  LEFT JOIN customers AS c ON c.customer_id = x.customer_id
  LEFT JOIN order_items AS i ON i.customer_id = x.customer_id AND i.loan_account_id = x.loan_id
  JOIN sales_cases AS b ON b.sales_case_id = i.sales_case_id AND b.finalized = 1
    AND i.master_loan_item = 1
  LEFT JOIN countries AS y ON y.iso_2_abbreviation = i.country
  {_CHANNEL}
  LEFT JOIN span_by_name AS sp ON sp.sa_name = lower(coalesce(c.application_by_contractor_name,
    h.sales_agent_name, i.sales_order_submitted_by_name))
  LEFT JOIN span_by_id AS si ON si.associator_id = c.application_by_contractor_id
  WHERE x.loan_state = 'active' AND a.initial_amount > 0 AND x.report_date >= DATE '2023-04-01'
  GROUP BY 1, 2, 3, 4, 5, 6, 7"""

LISTED = """listed AS (
  SELECT loan_id AS loan_account_id FROM benchmark_days GROUP BY loan_id
  HAVING count(*) FILTER (WHERE loan_state = 'active') = 0
)"""


def _join(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def _bodies() -> dict[str, str]:
    arms = (PERIOD, PAID)
    return {
        "mtd_calendar": _join(PERIOD, ALL_PAID) + """,
per_day AS (SELECT payment_date, count(*) AS n FROM all_paid GROUP BY 1),
held AS (SELECT country, count(*) AS customers FROM customers GROUP BY 1)
SELECT held.country, held.customers, cal.period, cal.day AS generated_date,
       coalesce(per_day.n, 0) AS payments
FROM held CROSS JOIN cal
LEFT JOIN per_day ON per_day.payment_date = cal.day AND held.country = 'UG'""",
        "daily_payments_unified": _join(PERIOD, ALL_PAID) + """
SELECT a.* FROM all_paid AS a JOIN period AS p ON a.payment_date BETWEEN p.day_from AND p.day_to""",
        "latest_snapshot_per_loan": _join(PERIOD) + """
SELECT period, loan_id, benchmark_date, loan_state, days_elapsed FROM (
  SELECT p.period, d.*, row_number() OVER (PARTITION BY p.period, d.loan_id
    ORDER BY d.benchmark_date DESC NULLS FIRST) AS rn
  FROM benchmark_days AS d JOIN period AS p ON d.benchmark_date BETWEEN p.back_from AND p.day_to
) AS x WHERE rn = 1""",
        "carry_forward_calendar": _join(PERIOD) + """
SELECT x.period, x.loan_id, x.benchmark_date, x.days_elapsed, cal.day AS report_date FROM (
  SELECT p.period, d.loan_id, d.benchmark_date, d.days_elapsed,
    row_number() OVER (PARTITION BY p.period, d.loan_id
      ORDER BY d.benchmark_date DESC NULLS FIRST) AS rn
  FROM metered_days AS d JOIN period AS p ON d.benchmark_date BETWEEN p.back_from AND p.day_to
) AS x JOIN cal ON cal.period = x.period WHERE rn = 1""",
        "paid_vs_expected_actual_or_latest": _join(*arms, METERED_ARM, HUB_ONLY, BENCHMARK_ARM)
        + "\nSELECT * FROM metered_out UNION ALL SELECT * FROM benchmark_out",
        "expected_schedule_admin": _join(*arms, SNAPSHOT_ARM) + "\nSELECT * FROM snapshot_out",
        "paid_vs_expected_periods": _join(*arms, METERED_ARM, SNAPSHOT_ARM, BENCHMARK_ARM) + f"""
SELECT x.*, r.end_of_month_rate AS eom_rate_usd FROM (
  SELECT * FROM metered_out UNION ALL SELECT * FROM snapshot_out
  UNION ALL SELECT * FROM benchmark_out) AS x
LEFT JOIN fx_rates AS r ON r.month = last_day(x.report_date)
  AND r.country = {COUNTRY_OF_CODE.format(c='x.country')}""",
        "month_end_rate": f"""
SELECT a.loan_account_id AS loan_id, CAST(a.handover_at_utc AS DATE) AS report_date, c.country,
       r.end_of_month_rate AS eom_rate_usd
FROM loan_accounts AS a LEFT JOIN customers AS c ON c.customer_id = a.customer_id
LEFT JOIN fx_rates AS r ON r.month = last_day(CAST(a.handover_at_utc AS DATE))
  AND r.country = {COUNTRY_OF_CODE.format(c='c.country')}""",
        "prior_month_end_lookup": """
SELECT d.loan_id, d.benchmark_date, r.report_date AS prior_month_end, r.loan_contract_end_date
FROM benchmark_days AS d LEFT JOIN benchmark_finance_monthly AS r ON r.loan_id = d.loan_id
  AND r.report_date = CAST(date_trunc('month', d.benchmark_date) AS DATE) - 1""",
        "payer_first_sale": _join(PAYERS) + "\nSELECT * FROM payer",
        "payer_per_phone": f"""
SELECT sender_phone, account_id, payment_id FROM (
  SELECT x.account_id, x.payment_id, {SENDER} AS sender_phone,
    row_number() OVER (PARTITION BY {SENDER} ORDER BY x.account_id, x.payment_id) AS rn
  FROM metered_account_transactions AS x LEFT JOIN payments AS y ON y.id = x.payment_id
  WHERE x.transaction_type_id IN (2, 4) AND x.payment_id IS NOT NULL) AS z WHERE rn = 1""",
        "normalised_key_join": f"""
SELECT y.id, {SENDER} AS phone, w.person_id
FROM payments AS y LEFT JOIN persons AS w ON w.primary_phone = {SENDER}""",
        "associator_contact": """
SELECT s.account_id AS dd_account_id, s.associator_name AS associate_name,
       p.primary_phone AS associate_phone
FROM metered_sales AS s LEFT JOIN persons AS p ON p.person_id = s.associator_id
WHERE s.sales_order_count = 1""",
        "best_item_per_customer": _join(BEST_LOAN)
        + "\nSELECT customer_id, loan_account_id, source FROM best_loan",
        "three_system_profile": PROFILE,
        "right_join_null_rejecting": """
SELECT q.loan_id, q.customer_id, q.first_payment_due
FROM loan_accounts AS a RIGHT JOIN first_payments AS q ON q.loan_id = a.loan_account_id
  AND q.customer_id = a.customer_id WHERE a.source = 'admin'""",
        "usual_payment_amount": _join(USUAL) + "\nSELECT * FROM usual",
        "payment_statistics": _join(STATISTICS) + "\nSELECT * FROM statistics",
        "monthly_payment_profile": _month_profile("2023-12-31", "2024-01-15"),
        "repayment_behaviour": _join(USUAL, STATISTICS) + """
SELECT u.loan_id, u.loan_type, u.months_since_loan_start, u.customer_id, u.customer_name,
  u.primary_phone_number, u.other_phone_numbers, u.region, u.district, u.parish, u.direction,
  u.assigned_to_agent_id, u.assigned_to_agent_name, u.product, u.product_segmentation,
  round(u.daily_rate) AS daily_rate, u.lighting_days_paid_for,
  CASE WHEN u.lighting_days_paid_for IN (1, 2) THEN 'daily (every 1-2days)'
       WHEN u.lighting_days_paid_for IN (3, 4, 5) THEN 'daily(every 3-4days)'
       WHEN u.lighting_days_paid_for IN (6, 7) THEN 'Weekly(every 5-7days)'
       WHEN u.lighting_days_paid_for BETWEEN 12 AND 16 THEN 'bi-weekly'
       WHEN u.lighting_days_paid_for BETWEEN 17 AND 35 THEN 'monthly'
       WHEN u.lighting_days_paid_for >= 36 THEN 'beyond monthly' ELSE 'Irregular' END
    AS frequency_lighting_type,
  u.month_end, u.frequency, u.trans_amount AS median_amount, s.total_transactions, s.max_payment,
  s.min_payment, s.avg_payment, CAST(sum(u.count_loans) AS BIGINT) AS nb_loans,
  sum(u.paid_mtd) AS paid_mtd, sum(u.expected_ongoing_mtd) AS expected_ongoing_mtd,
  sum(u.expected_mtd) AS expected_mtd
FROM usual AS u LEFT JOIN statistics AS s ON s.loan_id = u.loan_id AND s.month_end = u.month_end
GROUP BY ALL""",
        "local_month_end": f"""
SELECT country, last_day({_local('added_at_utc', 'country')}) AS month_end,
       count(*) AS transactions
FROM metered_transactions GROUP BY 1, 2""",
        "snapshot_vs_previous_month": f"""
WITH month_rows AS (
  SELECT DISTINCT loan_account_id, snapshot_at FROM snapshot_days
  WHERE snapshot_at = last_day(snapshot_at)
), terms AS (
  SELECT e.loan_account_id AS loan_id, e.snapshot_at AS month_end, m.snapshot_at AS previous_at,
    CAST(m.outstanding_amount AS DOUBLE) / 100 - CAST(d.outstanding_amount AS DOUBLE) / 100
      AS paid_mtd, z.country AS ctry, {_SCHEDULE_TERMS}
  FROM month_rows AS e
  JOIN snapshot_days AS d ON d.loan_account_id = e.loan_account_id
    AND d.snapshot_at = e.snapshot_at
  LEFT JOIN snapshot_days AS m ON m.loan_account_id = e.loan_account_id
    AND m.snapshot_at = d.snapshot_prev_month
  JOIN loan_accounts AS a ON a.loan_account_id = e.loan_account_id
  LEFT JOIN order_items AS i ON i.loan_account_id = e.loan_account_id AND i.master_loan_item = 1
  LEFT JOIN customers AS z ON z.customer_id = d.customer_id
)
SELECT loan_id, month_end, previous_at, paid_mtd, CAST({_EXPECTED} AS DOUBLE) AS expected_mtd,
       CAST({_ONGOING} AS DOUBLE) AS expected_ongoing_mtd
FROM terms""",
        "product_segment": f"""
SELECT product_type, wattage, {_segment('wattage', 'product_type')} AS segment
FROM product_mapping""",
        "agent_sales_span_by_name": _join(SPANS) + "\nSELECT * FROM span_by_name",
        "agent_sales_span_by_id": _join(SPANS) + "\nSELECT * FROM span_by_id",
        "reassigned_span": _join(SPANS) + """
SELECT v.to_contractor_name AS reassigned_agent_name,
  c.adopted_by_contractor_id AS reassigned_agent_id, c.customer_id,
  v.to_contractor_role_name AS reassigned_agent_role,
  min(coalesce(n.first_sale, i.first_sale)) AS first_sale_at,
  max(coalesce(n.last_sale, i.last_sale)) AS last_sale_at
FROM customers AS c
LEFT JOIN reassigned_customers AS v ON v.to_contractor_id = c.adopted_by_contractor_id
  AND v.customer_id = c.customer_id
LEFT JOIN span_by_name AS n ON n.sa_name = lower(v.to_contractor_name)
LEFT JOIN span_by_id AS i ON i.associator_id = c.adopted_by_contractor_id
GROUP BY 1, 2, 3, 4""",
        "earliest_link": """
SELECT powerhub_entry_id, fenixdb_entry_id, inserted_at_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY powerhub_entry_id
    ORDER BY inserted_at_utc NULLS LAST, fenixdb_entry_id) AS rn
  FROM contractor_links WHERE powerhub_entry_type = 'Contractor') AS x WHERE rn = 1""",
        "orphan_by_month": ORPHANS,
        "known_by_date_match": """
SELECT x.loan_id, x.report_date,
  EXISTS (SELECT 1 FROM reassigned_customers AS v WHERE v.customer_id = x.customer_id
          AND CAST(v.created_at_utc AS DATE) <= x.report_date) AS known
FROM benchmark_finance_monthly AS x""",
        "reconcile_at_month_end": f"""WITH {LISTED}
SELECT a.loan_account_id, a.migrated_loan, f.report_date AS month_end,
  a.last_benchmark_date AS last_benchmark_date_lad, f.benchmark_date AS benchmark_date_finance,
  a.state AS state_lad, a.state_detailed AS state_detailed_lad, f.loan_state,
  coalesce(a.canceled_at_utc, a.paid_off_at_utc) AS "cancellation or completion date_lad",
  coalesce(f.loan_cancelled_at_utc, f.loan_completed_at_utc)
    AS "cancellation or completion date_finance",
  CAST(a.amount_remaining AS DOUBLE) AS amount_remaining,
  CAST(g.remaining_all AS DOUBLE) AS remaining_all,
  CAST(g.remaining_net_unfin AS DOUBLE) AS remaining_net_unfin,
  a.percent_locked AS percent_locked_lad, f.percent_locked AS percent_locked_finance,
  a.par_days AS par_days_lad, f.par_days AS par_days_finance, a.risk_category,
  a.days_prepaid_remaining, a.inserted_at_utc,
  CAST(g.accounts_receivable_all AS DOUBLE) AS ar,
  CAST(g.accounts_receivable_net_unfin AS DOUBLE) AS ar_net_unfin
FROM loan_accounts AS a
LEFT JOIN benchmark_finance_monthly AS f ON f.loan_id = a.loan_account_id
LEFT JOIN benchmark_finance_calculations AS g ON g.loan_id = a.loan_account_id
  AND g.report_date = f.report_date
WHERE f.report_date = last_day(a.last_benchmark_date)
  AND a.loan_account_id IN (SELECT loan_account_id FROM listed)""",
        "id_list_semi_join": f"""WITH {LISTED}
SELECT loan_account_id, state, source FROM loan_accounts
WHERE loan_account_id IN (SELECT loan_account_id FROM listed)""",
        "left_join_residual": """
SELECT d.loan_id, d.benchmark_date, d.days_elapsed, s.introductory_period
FROM metered_days AS d LEFT JOIN metered_sales AS s ON s.loan_id = d.loan_id
  AND s.account_id = d.account_id AND d.days_elapsed > s.introductory_period""",
        "left_join_left_side_predicate": """
SELECT i.sales_order_item_id, i.master_loan_item, c.finalized
FROM order_items AS i LEFT JOIN sales_cases AS c ON c.sales_case_id = i.sales_case_id
  AND c.finalized = 1 AND i.master_loan_item = 1""",
        "cents_and_rounding": """
SELECT loan_account_id, CAST(initial_installment AS DOUBLE) / 100 AS installment,
  round(coalesce(CAST(daily_rate AS DOUBLE) / 100, CAST(initial_installment AS DOUBLE) / 100
    / nullif(installment_period_days, 0))) AS rate,
  CAST(amount_remaining AS DOUBLE) / nullif(installment_period_days, 0) AS per_day,
  round(CAST(amount_remaining AS DOUBLE) / nullif(CAST(daily_rate AS DOUBLE), 0)) AS light
FROM loan_accounts""",
    }


def _replaced(text: str, *changes: tuple[str, str]) -> str:
    for old, new in changes:
        assert old in text, old
        text = text.replace(old, new)
    return text


def _paid_vs_expected(as_of: date, code: str = "UG", name: str = "Uganda") -> str:
    """Paid against expected of another day or country, with the rules that differ there."""
    end = as_of - timedelta(days=1)
    month = end.replace(day=1)
    last_month_end = month - timedelta(days=1)
    last_month = (last_month_end.replace(day=1), min(last_month_end, last_month_end.replace(day=min(end.day, last_month_end.day))))
    last_year = (month.replace(year=month.year - 1), end.replace(year=end.year - 1))
    back = (as_of.replace(day=1) - timedelta(days=1)).replace(day=1)
    period = _replaced(
        PERIOD,
        ("DATE '2024-03-01', DATE '2024-03-30', DATE '2024-02-01'", f"DATE '{month}', DATE '{end}', DATE '{back}'"),
        ("DATE '2024-02-01', DATE '2024-02-29', DATE '2024-02-01'",
         f"DATE '{last_month[0]}', DATE '{last_month[1]}', DATE '{last_month[0]}'"),
        ("DATE '2023-03-01', DATE '2023-03-30', DATE '2023-03-01'",
         f"DATE '{last_year[0]}', DATE '{last_year[1]}', DATE '{last_year[0]}'"),
    )
    paid = _replaced(
        PAID,
        ("WHERE date_trunc('month', payment_date) = DATE '2024-03-01'",
         f"WHERE date_trunc('month', payment_date) = DATE '{as_of.replace(day=1)}'"),
        ("DATE '2024-02-01' AND payment_date < DATE '2024-03-01'", f"DATE '{last_month[0]}' AND payment_date < DATE '{month}'"),
        ("DATE '2023-03-01' AND payment_date < DATE '2024-03-01'", f"DATE '{last_year[0]}' AND payment_date < DATE '{month}'"),
        ("day(payment_date) <= 30", f"day(payment_date) <= {end.day}"),
    )
    metered, snapshot, benchmark = METERED_ARM, SNAPSHOT_ARM, BENCHMARK_ARM
    if code != "UG":
        paid = _replaced(paid, ("LIKE 'ug%'", f"LIKE '{code.lower()}%'"), ("country = 'UG'", f"country = '{code}'"))
        metered = _replaced(metered, ("WHERE s.country_of_sale = 'Uganda'", f"WHERE s.country_of_sale = '{name}'"))
        benchmark = _replaced(benchmark, ("WHERE c.country = 'UG'", f"WHERE c.country = '{code}'"))
        snapshot = _replaced(
            snapshot,
            ("c.country = 'UG'", f"c.country = '{code}'"),
            # rates of 30.5 days for every loan type
            ("WHEN loan_type = 'paygo' AND handover <= DATE '2022-04-14' THEN inst / 30.5\n"
             "               WHEN loan_type = 'paygo' THEN inst\n"
             "               WHEN loan_type = 'arrears' THEN item_rate\n"
             "               ELSE inst / 30.5 END", "WHEN TRUE THEN inst / 30.5 END"),
        )
    if code == "KE":
        snapshot = _replaced(
            snapshot,
            ("THEN h.hub_region ELSE", "THEN k.subcounty ELSE"),
            ("  LEFT JOIN hub AS h", "  LEFT JOIN hub_stock_point AS k ON k.hub_id = c.hub_id\n  LEFT JOIN hub AS h"),
            ("dpd AS intro", "CASE WHEN loan_type <> 'paygo' OR day < DATE '2022-03-21' THEN 30.5 "
                             "WHEN loan_type = 'paygo' THEN 7 ELSE dpd END AS intro"),
            ("WHEN state IN ('rescheduled', 'canceled', 'paid_off') THEN 0", "WHEN state IN ('rescheduled', 'paid_off') THEN 0"),
        )
    if code == "TZ":
        snapshot = _replaced(
            snapshot,
            ("THEN h.hub_region ELSE", "THEN g.region ELSE"),
            ("m.manager_name,", "g.manager AS manager_name,"),
            ("  LEFT JOIN hub AS h", "  LEFT JOIN area_manager AS g ON g.area2 = c.area2\n  LEFT JOIN hub AS h"),
            ("dpd AS intro", "CASE WHEN loan_type <> 'paygo' THEN 30.5 ELSE dpd END AS intro"),
        )
    return _join(period, paid, metered, snapshot, benchmark) + f"""
SELECT x.*, r.end_of_month_rate AS eom_rate_usd FROM (
  SELECT * FROM metered_out UNION ALL SELECT * FROM snapshot_out
  UNION ALL SELECT * FROM benchmark_out) AS x
LEFT JOIN fx_rates AS r ON r.month = last_day(x.report_date)
  AND r.country = {COUNTRY_OF_CODE.format(c='x.country')}"""


def _variants(bodies: dict[str, str]) -> dict[str, str]:
    """The behaviour report from the middle of a month, and with its amounts in order; paid
    against expected on the 1st, and in countries with rules of their own."""
    report = bodies["repayment_behaviour"]
    swapped = f"{_EXPECTED} AS expected_first, {_ONGOING} AS expected_second"
    ordered = f"{_ONGOING} AS expected_first, {_EXPECTED} AS expected_second"
    assert report.count(swapped) == 1
    return {
        "repayment_behaviour_mid_month": report.replace("DATE '2023-12-31'", "DATE '2024-01-15'"),
        "repayment_behaviour_ordered": report.replace(swapped, ordered),
        "repayment_behaviour_naive_local": _replaced(report, ("t.transaction_at + (", "t.transaction_at - (")),
        "paid_vs_expected_first_of_month": _paid_vs_expected(date(2024, 4, 1)),
        "paid_vs_expected_kenya": _paid_vs_expected(date(2022, 3, 28), "KE", "Kenya"),
        "paid_vs_expected_tanzania": _paid_vs_expected(date(2024, 3, 31), "TZ", "Tanzania"),
    }


def check_queries() -> dict[str, str]:
    bodies = _bodies()
    return {name: check_sql(body) for name, body in (bodies | _variants(bodies)).items()}
