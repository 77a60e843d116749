"""DuckDB SQL twins of every registered query (the correctness oracle).

Written independently in plain SQL over the driver's views.  Rounded ratios
and averages use exact integer/decimal arithmetic here because DuckDB turns
DECIMAL division into DOUBLE (and rounds doubles differently from Spark);
the stable hash is the same md5 prefix the engine uses.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
LOAD_TS = "TIMESTAMP '2001-12-31 00:00:00'"
PREV_AS_OF = "DATE '2000-12-31'"
YEAR_LO, YEAR_HI = 1998, 2001  # year(as_of - 3 years) .. year(as_of)


def h32(salt: str, *keys: str) -> str:
    ks = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{salt}', {ks})), 1, 8)) AS BIGINT)"


def s32(hex_expr: str, i: int) -> str:
    return f"CAST(('0x' || substr({hex_expr}, {1 + 8 * i}, 8)) AS BIGINT)"


def pick(values: list[str], h: str) -> str:
    lst = ", ".join(f"'{v}'" for v in values)
    return f"([{lst}])[({h}) % {len(values)} + 1]"


def rdiv(num: str, den: str) -> str:
    """round-half-up(num / den) for non-negative integers, exact (HUGEINT)."""
    return f"((2 * CAST({num} AS HUGEINT) + CAST({den} AS HUGEINT)) // (2 * CAST(NULLIF({den}, 0) AS HUGEINT)))"


def avg2_money(x: str) -> str:
    """ROUND(AVG(money), 2) exactly; null for no rows."""
    return f"CAST({rdiv(f'SUM({x}) * 100', f'COUNT({x})')} AS DECIMAL(38,0)) * 0.01"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("customers", [], f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS full_name,
       CAST(18 + c.c_custkey % 63 AS INTEGER) AS age,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       n.n_name AS county,
       DATE '1995-01-01' + CAST((c.c_custkey * 37) % 2400 AS INTEGER) AS signup_date,
       {LOAD_TS} AS ingested_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("policies", [], """
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderpriority AS policy_type, CAST(o_totalprice AS DECIMAL(12,2)) AS premium,
       CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 1825 AS end_date,
       CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Expired' WHEN 'P' THEN 'Pending' END AS status
FROM orders""")

cte("agents", [], """
SELECT CAST(s.s_suppkey AS VARCHAR) AS agent_id, s.s_name AS full_name, n.n_name AS county,
       DATE '1990-01-01' + CAST((s.s_suppkey * 53) % 3650 AS INTEGER) AS hire_date,
       CASE WHEN s.s_acctbal >= 0 THEN 'Active' ELSE 'Inactive' END AS status
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")

_STATUS = """CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Approved'
                 WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'Pending'
                 WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 'Paid'
                 WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'Rejected'
                 WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'Escalated'
                 WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Under Review' END"""

cte("claims", [], f"""
SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS claim_id,
       CAST(l.l_orderkey AS VARCHAR) AS policy_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       {pick(['Medical', 'Accident', 'Theft', 'Fire', 'Death'], 'l.l_partkey')} AS claim_type,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS claim_amount,
       {_STATUS} AS claim_status,
       CAST(o.o_orderdate AS DATE) AS incident_date, CAST(l.l_shipdate AS DATE) AS claim_date,
       CAST(CASE WHEN ({_STATUS}) IN ('Approved', 'Paid')
                 THEN ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2)
                 ELSE 0 END AS DECIMAL(12,2)) AS approved_amount,
       {LOAD_TS} AS created_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("region_map", [], """
SELECT n.n_name AS county, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("calendar", ["policies"], f"""
SELECT CAST(d AS DATE) AS date_key
FROM (SELECT unnest(generate_series(CAST(date_trunc('year', min(start_date) - 3) AS TIMESTAMP),
                                    CAST(DATE '2002-12-31' AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM policies)""")

cte("dim_date", ["calendar"], """
SELECT date_key, CAST(day(date_key) AS INTEGER) AS day, CAST(month(date_key) AS INTEGER) AS month,
       monthname(date_key) AS month_name, CAST(quarter(date_key) AS INTEGER) AS quarter,
       'Q' || quarter(date_key) || ' ' || year(date_key) AS quarter_name,
       CAST(year(date_key) AS INTEGER) AS year, CAST(isodow(date_key) AS INTEGER) AS day_of_week,
       dayname(date_key) AS day_name, isodow(date_key) >= 6 AS is_weekend,
       day(date_key) = 1 AS is_month_start, date_key = last_day(date_key) AS is_month_end,
       CAST(week(date_key) AS INTEGER) AS week_of_year
FROM calendar""")

cte("dim_policy_type", ["policies"], """
SELECT CAST(row_number() OVER (ORDER BY policy_type) AS INTEGER) AS policy_type_id, policy_type
FROM (SELECT DISTINCT policy_type FROM policies WHERE policy_type IS NOT NULL)""")

cte("dim_county", ["customers"], """
SELECT CAST(row_number() OVER (ORDER BY county_name) AS INTEGER) AS county_id, county_name
FROM (SELECT DISTINCT county AS county_name FROM customers WHERE county IS NOT NULL)""")

cte("dim_claim_status", [], """
SELECT CAST(status_id AS INTEGER) AS status_id, status_name
FROM (VALUES (1, 'Pending'), (2, 'Approved'), (3, 'Rejected'), (4, 'Paid'), (5, 'Escalated')) t(status_id, status_name)""")

cte("dim_customer", ["customers", "region_map"], f"""
SELECT c.customer_id, c.full_name, c.age,
       CASE WHEN c.age <= 25 THEN '18-25' WHEN c.age <= 35 THEN '26-35' WHEN c.age <= 45 THEN '36-45'
            WHEN c.age <= 55 THEN '46-55' WHEN c.age <= 65 THEN '56-65' ELSE '66+' END AS age_band,
       c.gender, c.county, COALESCE(rm.region, 'Other') AS region, c.signup_date,
       CASE WHEN c.signup_date IS NULL THEN 'Unknown'
            WHEN ({AS_OF} - c.signup_date) < 365 THEN 'New'
            WHEN ({AS_OF} - c.signup_date) < 730 THEN 'Established' ELSE 'Loyal' END AS customer_tenure,
       c.ingested_at
FROM customers c LEFT JOIN region_map rm ON c.county = rm.county""")

cte("dim_agent", ["agents", "region_map"], f"""
SELECT a.agent_id, a.full_name AS agent_name, upper(substr(a.agent_id, 1, 8)) AS agent_code,
       COALESCE(rm.region, 'Other') AS region,
       {pick(['Direct', 'Broker', 'Online', 'Bancassurance'], h32('channel', 'a.agent_id'))} AS channel,
       a.hire_date, a.status IS NOT DISTINCT FROM 'Active' AS is_active
FROM agents a LEFT JOIN region_map rm ON a.county = rm.county""")

cte("cust_county", ["dim_customer", "dim_county"], """
SELECT dc.customer_id, dc.county, co.county_id
FROM dim_customer dc LEFT JOIN dim_county co ON dc.county = co.county_name""")

cte("active_agents", ["dim_agent"], """
SELECT agent_id, row_number() OVER (ORDER BY agent_id) - 1 AS slot
FROM (SELECT DISTINCT agent_id FROM dim_agent WHERE is_active)""")

cte("fact_sales", ["policies", "cust_county", "dim_policy_type", "active_agents"], f"""
SELECT md5(concat_ws('|', 'sale', p.policy_id)) AS sale_id, p.policy_id, p.customer_id, aa.agent_id,
       p.start_date AS date_key, pt.policy_type_id, cc.county_id, p.premium AS premium_amount,
       CAST(CAST(500 + {h32('commission', 'p.policy_id')} % 1001 AS DECIMAL(9,0)) * 0.0001 AS DECIMAL(5,4))
         AS commission_rate,
       p.policy_type, p.start_date, p.end_date, p.status AS policy_status
FROM policies p
LEFT JOIN cust_county cc ON p.customer_id = cc.customer_id
LEFT JOIN dim_policy_type pt ON p.policy_type = pt.policy_type
LEFT JOIN active_agents aa
       ON aa.slot = {h32('agent', 'p.policy_id')} % NULLIF((SELECT count(*) FROM active_agents), 0)""")

cte("claims_joined", ["claims", "cust_county", "policies", "dim_policy_type", "dim_claim_status"], """
SELECT c.*, cc.county_id, pt.policy_type_id, cs.status_id
FROM claims c
LEFT JOIN cust_county cc ON c.customer_id = cc.customer_id
LEFT JOIN policies p ON c.policy_id = p.policy_id
LEFT JOIN dim_policy_type pt ON p.policy_type = pt.policy_type
LEFT JOIN dim_claim_status cs ON c.claim_status = cs.status_name""")

cte("fact_claims", ["claims_joined"], f"""
SELECT claim_id, policy_id, customer_id, claim_date AS date_key, incident_date AS incident_date_key,
       status_id, county_id, policy_type_id, claim_type, claim_amount,
       COALESCE(approved_amount, CAST(0 AS DECIMAL(12,2))) AS approved_amount, claim_status,
       incident_date, claim_date, COALESCE(created_at, {LOAD_TS}) AS created_at
FROM claims_joined""")

cte("sched_base", ["policies", "cust_county", "dim_policy_type"], f"""
SELECT p.policy_id, p.customer_id, p.premium, p.start_date, p.end_date, cc.county_id, pt.policy_type_id,
       {pick(['Monthly', 'Quarterly', 'Annual'], h32('frequency', 'p.policy_id'))} AS payment_frequency,
       LEAST(p.end_date, {AS_OF}) AS cutoff
FROM policies p
LEFT JOIN cust_county cc ON p.customer_id = cc.customer_id
LEFT JOIN dim_policy_type pt ON p.policy_type = pt.policy_type""")

cte("schedule", ["sched_base"], f"""
SELECT b.*, CASE b.payment_frequency WHEN 'Monthly' THEN 30 WHEN 'Quarterly' THEN 90 WHEN 'Annual' THEN 365 END AS step,
       CAST(CAST({rdiv('b.premium * 100', "CASE b.payment_frequency WHEN 'Monthly' THEN 12 WHEN 'Quarterly' THEN 4 WHEN 'Annual' THEN 1 END")}
                 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) AS expected_amount
FROM sched_base b WHERE b.start_date <= b.cutoff""")

cte("installments", ["schedule"], """
SELECT s.*, unnest(generate_series(0, (s.cutoff - s.start_date) // s.step)) AS installment_no
FROM schedule s""")

cte("payments_raw", ["installments"], f"""
SELECT i.*, i.start_date + CAST(i.installment_no * i.step AS INTEGER) AS due_date,
       md5(concat_ws('|', 'payment', i.policy_id, CAST(i.installment_no AS VARCHAR))) AS payment_id
FROM installments i""")

_PID = "r.payment_id"
cte("payment_rows", ["payments_raw"], f"""
SELECT q.*, CAST(CASE WHEN q.payment_status = 'Completed' AND q.partial
                      THEN ROUND(q.expected_amount * q.factor, 2)
                      WHEN q.payment_status IN ('Failed', 'Reversed') THEN 0
                      ELSE q.expected_amount END AS DECIMAL(12,2)) AS payment_amount
FROM (
  SELECT r.*, r.due_date + CAST(-3 + {s32(_PID, 0)} % 19 AS INTEGER) AS payment_date,
         {pick(['Completed', 'Completed', 'Completed', 'Pending', 'Failed', 'Reversed'], s32(_PID, 1))} AS payment_status,
         {s32(_PID, 2)} < 214748365 AS partial,
         {pick(['Mpesa', 'Bank Transfer', 'Cash', 'Card'], s32(_PID, 3))} AS payment_method,
         CAST(CAST(70 + {h32('factor', _PID)} % 30 AS DECIMAL(5,0)) * 0.01 AS DECIMAL(3,2)) AS factor
  FROM payments_raw r) q""")

cte("fact_payments", ["payment_rows", "dim_date"], f"""
SELECT payment_id, policy_id, customer_id, payment_date AS date_key, county_id, policy_type_id,
       payment_amount, expected_amount, CAST(payment_amount - expected_amount AS DECIMAL(12,2)) AS variance,
       payment_amount >= expected_amount AS is_full_payment, payment_method, payment_status, payment_frequency,
       payment_date > due_date AS is_late, CAST(GREATEST(0, payment_date - due_date) AS INTEGER) AS days_late,
       payment_date, due_date, {LOAD_TS} AS created_at
FROM payment_rows WHERE payment_date IN (SELECT date_key FROM dim_date)""")

cte("dates_window", ["dim_date"], f"""
SELECT date_key, year, month, month_name FROM dim_date WHERE year BETWEEN {YEAR_LO} AND {YEAR_HI}""")

_EVENT_KEY = "CAST(json_extract_string(e.props, '$.k') AS INTEGER)"
cte("events_msg", [], f"""
SELECT CASE e.event_type WHEN 'signup' THEN 'new_policy' WHEN 'error' THEN 'new_claim'
                         WHEN 'purchase' THEN 'new_payment' ELSE e.event_type END AS event_type,
       e.event_id, e.ts, e.user_id, CAST(e.value AS DECIMAL(15,2)) AS amount,
       'POL-' || CAST(e.user_id AS VARCHAR) AS holder, {_EVENT_KEY} AS k
FROM events e""")


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _money_cols(cols: list[tuple[str, bool]]) -> str:
    return ", ".join(dbl(c) + f" AS {c}" if is_money else c for c, is_money in cols)


# ---------------------------------------------------------------- queries ----
Q: dict[str, str] = {}

Q["dim_date"] = with_ctes(["dim_date"], "SELECT * FROM dim_date")
Q["dim_policy_type"] = with_ctes(["dim_policy_type"], "SELECT * FROM dim_policy_type")
Q["dim_county"] = with_ctes(["dim_county"], "SELECT * FROM dim_county")
Q["dim_customer"] = with_ctes(["dim_customer"], "SELECT * FROM dim_customer")
Q["dim_agent"] = with_ctes(["dim_agent"], "SELECT * FROM dim_agent")
Q["fact_sales"] = with_ctes(["fact_sales"], """
SELECT sale_id, policy_id, customer_id, agent_id, date_key, policy_type_id, county_id,
       CAST(premium_amount AS DOUBLE) AS premium_amount, CAST(commission_rate AS DOUBLE) AS commission_rate,
       policy_type, start_date, end_date, policy_status FROM fact_sales""")
Q["fact_claims"] = with_ctes(["fact_claims"], """
SELECT claim_id, policy_id, customer_id, date_key, incident_date_key, status_id, county_id, policy_type_id,
       claim_type, CAST(claim_amount AS DOUBLE) AS claim_amount, CAST(approved_amount AS DOUBLE) AS approved_amount,
       claim_status, incident_date, claim_date, created_at FROM fact_claims""")
Q["fact_payments"] = with_ctes(["fact_payments"], """
SELECT payment_id, policy_id, customer_id, date_key, county_id, policy_type_id,
       CAST(payment_amount AS DOUBLE) AS payment_amount, CAST(expected_amount AS DOUBLE) AS expected_amount,
       CAST(variance AS DOUBLE) AS variance, is_full_payment, payment_method, payment_status, payment_frequency,
       is_late, days_late, payment_date, due_date, created_at FROM fact_payments""")
Q["installment_schedule"] = with_ctes(["installments"], """
SELECT policy_id, payment_frequency, CAST(installment_no AS INTEGER) AS installment_no,
       start_date + CAST(installment_no * step AS INTEGER) AS due_date,
       CAST(expected_amount AS DOUBLE) AS expected_amount FROM installments""")

Q["monthly_premium"] = with_ctes(["fact_sales", "dates_window"], """
SELECT d.year, d.month, d.month_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS premium,
       CAST(ROUND(SUM(fs.commission_rate * fs.premium_amount), 2) AS DOUBLE) AS commission,
       COUNT(fs.sale_id) AS policies
FROM fact_sales fs JOIN dates_window d ON fs.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name""")

Q["county_premium"] = with_ctes(["fact_sales", "dim_county"], """
SELECT dc.county_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS total_premium, COUNT(fs.sale_id) AS policies
FROM fact_sales fs JOIN dim_county dc ON fs.county_id = dc.county_id GROUP BY dc.county_name""")

Q["policy_type_dist"] = with_ctes(["fact_sales"], """
SELECT policy_type, COUNT(*) AS count, CAST(ROUND(SUM(premium_amount), 2) AS DOUBLE) AS total_premium
FROM fact_sales GROUP BY policy_type""")

Q["claims_status"] = with_ctes(["fact_claims", "dim_claim_status"], """
SELECT cs.status_name, COUNT(fc.claim_id) AS claims, CAST(ROUND(SUM(fc.claim_amount), 2) AS DOUBLE) AS total_claimed,
       CAST(ROUND(SUM(fc.approved_amount), 2) AS DOUBLE) AS total_approved
FROM fact_claims fc JOIN dim_claim_status cs ON fc.status_id = cs.status_id GROUP BY cs.status_name""")

# the literal fan-out SQL (feasible at the oracle's scale), ratio made exact in cents
Q["loss_ratio_as_written"] = with_ctes(["fact_sales", "fact_claims", "dim_policy_type"], f"""
SELECT policy_type, CAST(NULL AS VARCHAR) AS risk_level, CAST(p AS DOUBLE) AS total_premium,
       CAST(a AS DOUBLE) AS total_approved,
       CAST(CAST({rdiv('a * 1000000', 'p * 100')} AS DECIMAL(38,0)) * 0.01 AS DOUBLE) AS loss_ratio_pct
FROM (SELECT pt.policy_type, ROUND(SUM(fs.premium_amount), 2) AS p, ROUND(SUM(fc.approved_amount), 2) AS a
      FROM dim_policy_type pt
      LEFT JOIN fact_sales fs ON fs.policy_type_id = pt.policy_type_id
      LEFT JOIN fact_claims fc ON fc.policy_type_id = pt.policy_type_id
      GROUP BY pt.policy_type) t""")

Q["loss_ratio_corrected"] = with_ctes(["fact_sales", "fact_claims", "dim_policy_type"], f"""
SELECT pt.policy_type, CAST(NULL AS VARCHAR) AS risk_level, CAST(s.p AS DOUBLE) AS total_premium,
       CAST(c.a AS DOUBLE) AS total_approved,
       CAST(CAST({rdiv('c.a * 1000000', 's.p * 100')} AS DECIMAL(38,0)) * 0.01 AS DOUBLE) AS loss_ratio_pct
FROM dim_policy_type pt
LEFT JOIN (SELECT policy_type_id, SUM(premium_amount) AS p FROM fact_sales GROUP BY 1) s ON s.policy_type_id = pt.policy_type_id
LEFT JOIN (SELECT policy_type_id, SUM(approved_amount) AS a FROM fact_claims GROUP BY 1) c ON c.policy_type_id = pt.policy_type_id""")

Q["agent_top10"] = with_ctes(["fact_sales", "dim_agent"], """
SELECT agent_name, channel, policies, CAST(total_premium AS DOUBLE) AS total_premium, CAST(commission AS DOUBLE) AS commission
FROM (SELECT da.agent_id, da.agent_name, da.channel, COUNT(fs.sale_id) AS policies,
             ROUND(SUM(fs.premium_amount), 2) AS total_premium,
             ROUND(SUM(fs.commission_rate * fs.premium_amount), 2) AS commission
      FROM fact_sales fs JOIN dim_agent da ON fs.agent_id = da.agent_id
      GROUP BY da.agent_id, da.agent_name, da.channel
      ORDER BY total_premium DESC NULLS FIRST, da.agent_id LIMIT 10) t""")

Q["payment_method"] = with_ctes(["fact_payments"], """
SELECT payment_method, COUNT(*) AS payments, CAST(ROUND(SUM(payment_amount), 2) AS DOUBLE) AS total_collected
FROM fact_payments WHERE payment_status = 'Completed' GROUP BY payment_method""")

Q["late_by_frequency"] = with_ctes(["fact_payments"], f"""
SELECT payment_frequency, COUNT(*) AS total, COUNT(*) FILTER (WHERE is_late = TRUE) AS late,
       CAST(CAST({rdiv('COUNT(*) FILTER (WHERE is_late = TRUE) * 1000', 'COUNT(*)')} AS DECIMAL(38,0)) * 0.1 AS DOUBLE) AS late_pct
FROM fact_payments GROUP BY payment_frequency""")

Q["age_band"] = with_ctes(["dim_customer", "fact_sales"], f"""
SELECT dc.age_band, COUNT(*) AS customers, CAST({avg2_money('fs.premium_amount')} AS DOUBLE) AS avg_premium
FROM dim_customer dc LEFT JOIN fact_sales fs ON dc.customer_id = fs.customer_id GROUP BY dc.age_band""")

Q["age_band_corrected"] = with_ctes(["dim_customer", "fact_sales"], f"""
SELECT dc.age_band, COUNT(DISTINCT dc.customer_id) AS customers, CAST({avg2_money('fs.premium_amount')} AS DOUBLE) AS avg_premium
FROM dim_customer dc LEFT JOIN fact_sales fs ON dc.customer_id = fs.customer_id GROUP BY dc.age_band""")

Q["collections_as_written"] = with_ctes(["dates_window", "fact_sales", "fact_payments"], """
SELECT d.year, d.month, d.month_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS gross_premium,
       CAST(ROUND(SUM(fp.payment_amount) FILTER (WHERE fp.payment_status = 'Completed'), 2) AS DOUBLE) AS collected
FROM dates_window d
LEFT JOIN fact_sales fs ON fs.date_key = d.date_key
LEFT JOIN fact_payments fp ON fp.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name""")

Q["collections_corrected"] = with_ctes(["dates_window", "fact_sales", "fact_payments"], """
SELECT d.year, d.month, d.month_name, CAST(ROUND(SUM(s.p), 2) AS DOUBLE) AS gross_premium,
       CAST(ROUND(SUM(c.c), 2) AS DOUBLE) AS collected
FROM dates_window d
LEFT JOIN (SELECT date_key, SUM(premium_amount) AS p FROM fact_sales GROUP BY 1) s ON s.date_key = d.date_key
LEFT JOIN (SELECT date_key, SUM(payment_amount) FILTER (WHERE payment_status = 'Completed') AS c
           FROM fact_payments GROUP BY 1) c ON c.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name""")

Q["summary_stats"] = with_ctes(["customers", "policies", "claims", "fact_sales", "fact_payments"], """
SELECT 'Total Customers' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM customers
UNION ALL SELECT 'Total Policies', CAST(COUNT(*) AS VARCHAR) FROM policies
UNION ALL SELECT 'Total Claims', CAST(COUNT(*) AS VARCHAR) FROM claims
UNION ALL SELECT 'Gross Premium (KES)', CAST(ROUND(SUM(premium_amount), 2) AS VARCHAR) FROM fact_sales
UNION ALL SELECT 'Total Collected (KES)', CAST(ROUND(SUM(payment_amount), 2) AS VARCHAR) FROM fact_payments
          WHERE payment_status = 'Completed'""")

Q["late_by_policy_type"] = with_ctes(["fact_payments", "dim_policy_type"], f"""
SELECT pt.policy_type, COUNT(*) FILTER (WHERE fp.is_late = TRUE) AS late_payments,
       COUNT(*) FILTER (WHERE fp.is_late = FALSE) AS on_time_payments,
       CAST(CAST({rdiv('SUM(fp.days_late) * 10', 'COUNT(fp.days_late)')} AS DECIMAL(38,0)) * 0.1 AS DOUBLE) AS avg_days_late
FROM fact_payments fp JOIN dim_policy_type pt ON fp.policy_type_id = pt.policy_type_id GROUP BY pt.policy_type""")

Q["sales_by_type"] = with_ctes(["fact_sales"], """
SELECT policy_type, COUNT(*) AS cnt, CAST(ROUND(SUM(premium_amount), 2) AS DOUBLE) AS total_premium
FROM fact_sales GROUP BY policy_type""")

Q["claims_totals_by_status"] = with_ctes(["fact_claims", "dim_claim_status"], """
SELECT cs.status_name, COUNT(*) AS claims, CAST(SUM(fc.claim_amount) AS DOUBLE) AS total_claimed,
       CAST(SUM(fc.approved_amount) AS DOUBLE) AS total_approved
FROM fact_claims fc JOIN dim_claim_status cs ON fc.status_id = cs.status_id GROUP BY cs.status_name""")

Q["payments_by_method_status_top10"] = with_ctes(["fact_payments"], """
SELECT payment_method, payment_status, payments, CAST(total_amount AS DOUBLE) AS total_amount
FROM (SELECT payment_method, payment_status, COUNT(*) AS payments, ROUND(SUM(payment_amount), 2) AS total_amount
      FROM fact_payments GROUP BY payment_method, payment_status
      ORDER BY payments DESC, payment_method, payment_status LIMIT 10) t""")

Q["v_premium_by_policy_type"] = with_ctes(["fact_sales", "dim_policy_type"], f"""
SELECT pt.policy_type, COUNT(*) AS policies, CAST({avg2_money('fs.premium_amount')} AS DOUBLE) AS avg_premium,
       CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS total_premium
FROM fact_sales fs JOIN dim_policy_type pt USING (policy_type_id) GROUP BY pt.policy_type""")

Q["v_claims_summary"] = with_ctes(["fact_claims", "dim_claim_status"], """
SELECT cs.status_name, COUNT(*) AS claims, CAST(ROUND(SUM(fc.claim_amount), 2) AS DOUBLE) AS total_claimed,
       CAST(ROUND(SUM(fc.approved_amount), 2) AS DOUBLE) AS total_approved,
       ROUND(AVG(CAST(fc.approved_amount AS DOUBLE) / NULLIF(CAST(fc.claim_amount AS DOUBLE), 0)) * 100, 1) AS approval_pct
FROM fact_claims fc JOIN dim_claim_status cs ON fc.status_id = cs.status_id GROUP BY cs.status_name""")

Q["v_payment_methods"] = with_ctes(["fact_payments"], f"""
SELECT payment_method, COUNT(*) AS transactions, CAST(ROUND(SUM(payment_amount), 2) AS DOUBLE) AS total_collected,
       CAST({avg2_money('payment_amount')} AS DOUBLE) AS avg_payment
FROM fact_payments GROUP BY payment_method""")

Q["v_monthly_trends"] = with_ctes(["fact_sales"], """
SELECT CAST(date_trunc('month', date_key) AS DATE) AS month, COUNT(DISTINCT sale_id) AS policies_sold,
       CAST(ROUND(SUM(premium_amount), 2) AS DOUBLE) AS premium_volume
FROM fact_sales GROUP BY 1""")

Q["v_summary_stats"] = with_ctes(["dim_customer", "fact_sales", "fact_claims", "fact_payments"], """
SELECT 'Total Customers' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM dim_customer
UNION ALL SELECT 'Total Policies', CAST(COUNT(*) AS VARCHAR) FROM fact_sales
UNION ALL SELECT 'Total Claims', CAST(COUNT(*) AS VARCHAR) FROM fact_claims
UNION ALL SELECT 'Total Payments', CAST(COUNT(*) AS VARCHAR) FROM fact_payments
UNION ALL SELECT 'Total Premium', CAST(ROUND(SUM(premium_amount), 0) AS VARCHAR) FROM fact_sales
UNION ALL SELECT 'Total Claimed', CAST(ROUND(SUM(claim_amount), 0) AS VARCHAR) FROM fact_claims
UNION ALL SELECT 'Total Collected', CAST(ROUND(SUM(payment_amount), 0) AS VARCHAR) FROM fact_payments""")

Q["dim_row_counts"] = with_ctes(["dim_date", "dim_customer", "dim_policy_type", "dim_county", "dim_agent",
                                 "dim_claim_status"], """
SELECT 'dim_date' AS table_name, COUNT(*) AS row_count FROM dim_date
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'dim_policy_type', COUNT(*) FROM dim_policy_type
UNION ALL SELECT 'dim_county', COUNT(*) FROM dim_county
UNION ALL SELECT 'dim_agent', COUNT(*) FROM dim_agent
UNION ALL SELECT 'dim_claim_status', COUNT(*) FROM dim_claim_status""")


def _checks(table: str, rules: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS \"check\", COUNT(*) FILTER (WHERE {r}) AS failures FROM {table}"
                               for n, r in rules)


Q["dq_sales"] = with_ctes(["policies", "dim_customer"], "SELECT * FROM (" + _checks(
    "(SELECT p.*, dc.customer_id IS NOT NULL AS known FROM policies p "
    "LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer) dc ON p.customer_id = dc.customer_id) x", [
        ("null policy_id", "policy_id IS NULL"), ("null customer_id", "customer_id IS NULL"),
        ("null premium", "premium IS NULL"), ("null start_date", "start_date IS NULL"),
        ("premium out of range", "premium < 0 OR premium > 1000000"),
        ("end_date before start_date", "end_date < start_date"), ("unmatched customer_id", "NOT known")]) + ")")

Q["dq_claims"] = with_ctes(["claims"], "SELECT * FROM (" + _checks("claims", [
    ("null claim_id", "claim_id IS NULL"), ("null customer_id", "customer_id IS NULL"),
    ("null policy_id", "policy_id IS NULL"), ("negative claim_amount", "claim_amount < 0"),
    ("null claim_amount", "claim_amount IS NULL"),
    ("claim_date before incident_date", "claim_date < incident_date")]) + ")")

Q["dq_payments"] = with_ctes(["policies"], "SELECT * FROM (" + _checks("policies", [
    ("null policy_id", "policy_id IS NULL"), ("null customer_id", "customer_id IS NULL"),
    ("null premium", "premium IS NULL"), ("negative premium", "premium < 0"),
    ("null start_date", "start_date IS NULL")]) + ")")

Q["lookup_misses"] = with_ctes(["claims_joined"], "SELECT * FROM (" + _checks("claims_joined", [
    ("unmatched status", "status_id IS NULL"), ("unmatched policy type", "policy_type_id IS NULL"),
    ("unmatched county", "county_id IS NULL")]) + ")")

_FS_COLS = ["sale_id", "policy_id", "customer_id", "agent_id", "date_key", "policy_type_id", "county_id",
            "premium_amount", "commission_rate", "policy_type", "start_date", "end_date", "policy_status"]
_FACT_COLS = {
    "fact_sales": _FS_COLS,
    "fact_claims": ["claim_id", "policy_id", "customer_id", "date_key", "incident_date_key", "status_id", "county_id",
                    "policy_type_id", "claim_type", "claim_amount", "approved_amount", "claim_status", "incident_date",
                    "claim_date", "created_at"],
    "fact_payments": ["payment_id", "policy_id", "customer_id", "date_key", "county_id", "policy_type_id", "payment_amount",
                      "expected_amount", "variance", "is_full_payment", "payment_method", "payment_status",
                      "payment_frequency", "is_late", "days_late", "payment_date", "due_date", "created_at"]}
Q["null_profile"] = with_ctes(list(_FACT_COLS), "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {t}"
    for t, cols in _FACT_COLS.items() for c in cols) + ")")

Q["value_counts"] = with_ctes(["fact_payments"], "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM fact_payments GROUP BY {c}"
    for c in ["payment_method", "payment_status", "payment_frequency"]) + ")")

Q["verify_sales"] = with_ctes(["fact_sales", "dim_customer"], """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE fs.premium_amount IS NULL) AS null_premiums,
       COUNT(*) FILTER (WHERE dc.customer_id IS NULL) AS orphaned_rows
FROM fact_sales fs LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer) dc ON fs.customer_id = dc.customer_id""")

Q["reconcile_claims"] = with_ctes(["claims", "fact_claims"], """
SELECT (SELECT COUNT(*) FROM claims) AS source_claims, (SELECT COUNT(*) FROM fact_claims) AS fact_claims,
       (SELECT COUNT(*) FROM claims c LEFT JOIN (SELECT DISTINCT claim_id FROM fact_claims) f
          ON c.claim_id = f.claim_id WHERE f.claim_id IS NULL) AS missing_rows,
       (SELECT COUNT(*) FROM fact_claims WHERE claim_amount IS NULL) AS null_amounts""")

Q["verify_payments"] = with_ctes(["fact_payments"], """
SELECT COUNT(*) AS total_payments, COUNT(*) FILTER (WHERE payment_amount IS NULL) AS null_amounts,
       COUNT(*) FILTER (WHERE is_late = TRUE) AS late_payments,
       COUNT(*) FILTER (WHERE payment_status IN ('Failed', 'Reversed')) AS failed_or_reversed,
       CAST(ROUND(SUM(payment_amount) FILTER (WHERE payment_status = 'Completed'), 2) AS DOUBLE) AS total_collected
FROM fact_payments""")

Q["new_rows_only"] = with_ctes(["fact_sales"], f"""
SELECT sale_id, policy_id, customer_id, date_key, CAST(premium_amount AS DOUBLE) AS premium_amount
FROM fact_sales f
WHERE NOT EXISTS (SELECT 1 FROM fact_sales t WHERE t.start_date <= {PREV_AS_OF}
                  AND t.policy_id IS NOT DISTINCT FROM f.policy_id)""")

Q["rows_with_valid_date"] = with_ctes(["fact_payments"], """
SELECT payment_id, policy_id, date_key, CAST(payment_amount AS DOUBLE) AS payment_amount FROM fact_payments
WHERE date_key <= DATE '2001-12-31'""")

Q["dropped_dates"] = with_ctes(["payment_rows", "dim_date"], """
SELECT payment_id, policy_id, payment_date AS date_key, CAST(payment_amount AS DOUBLE) AS payment_amount
FROM payment_rows WHERE payment_date NOT IN (SELECT date_key FROM dim_date WHERE date_key <= DATE '2001-12-31')""")

Q["orphan_customers"] = with_ctes(["policies", "dim_customer"], """
SELECT COUNT(*) AS orphan_policies, COUNT(DISTINCT customer_id) AS orphan_customer_ids
FROM policies p WHERE NOT EXISTS (SELECT 1 FROM dim_customer dc WHERE dc.customer_id = p.customer_id)""")

Q["hash_assigned_agent"] = with_ctes(["fact_sales"], "SELECT policy_id, agent_id FROM fact_sales")

Q["sampled_rows"] = with_ctes(["policies"], f"""
SELECT policy_id, customer_id, start_date, CAST(premium AS DOUBLE) AS premium FROM policies
WHERE {h32('claim', 'policy_id')} < 1717986918""")

Q["child_expansion"] = with_ctes(["policies"], f"""
SELECT payment_id, policy_id, customer_id,
       {AS_OF} - CAST({s32('payment_id', 0)} % 181 AS INTEGER) AS payment_date,
       CAST(CAST(CAST({rdiv('premium * 100', '6')} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       {pick(['M-Pesa', 'Bank', 'Card'], s32('payment_id', 1))} AS payment_method, 'Completed' AS status
FROM (SELECT p.*, md5(concat_ws('|', 'oltp_payment', p.policy_id, CAST(n AS VARCHAR))) AS payment_id
      FROM (SELECT *, unnest(generate_series(1, 1 + {h32('children', 'policy_id')} % 6)) AS n FROM policies) p)""")

Q["sales_records"] = with_ctes(["policies", "agents"], f"""
SELECT md5(concat_ws('|', 'oltp_sale', p.policy_id)) AS sale_id, p.policy_id, p.customer_id, a.agent_id,
       {AS_OF} AS sale_date, CAST(r.rate AS DOUBLE) AS commission_rate,
       CAST(ROUND(p.premium * r.rate, 2) AS DOUBLE) AS commission_amount, CAST(p.premium AS DOUBLE) AS premium_amount
FROM policies p
JOIN (SELECT p2.policy_id, CAST(CAST(5 + {h32('sale_rate', 'p2.policy_id')} % 11 AS DECIMAL(5,0)) * 0.01 AS DECIMAL(5,4)) AS rate
      FROM policies p2) r ON r.policy_id = p.policy_id
LEFT JOIN (SELECT agent_id, row_number() OVER (ORDER BY agent_id) - 1 AS slot
           FROM (SELECT DISTINCT agent_id FROM agents)) a
       ON a.slot = {h32('sale_agent', 'p.policy_id')} % NULLIF((SELECT count(DISTINCT agent_id) FROM agents), 0)""")

Q["period_labels"] = with_ctes(["fact_sales", "dates_window"], """
SELECT d.year, d.month, d.month_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS premium,
       CAST(ROUND(SUM(fs.commission_rate * fs.premium_amount), 2) AS DOUBLE) AS commission,
       COUNT(fs.sale_id) AS policies, substr(d.month_name, 1, 3) || ' ' || CAST(d.year AS VARCHAR) AS period
FROM fact_sales fs JOIN dates_window d ON fs.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name""")

Q["collections_chart"] = with_ctes(["dates_window", "fact_sales", "fact_payments"], """
SELECT *, substr(month_name, 1, 3) || ' ' || CAST(year AS VARCHAR) AS period FROM (
SELECT d.year, d.month, d.month_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS gross_premium,
       CAST(ROUND(SUM(fp.payment_amount) FILTER (WHERE fp.payment_status = 'Completed'), 2) AS DOUBLE) AS collected
FROM dates_window d
LEFT JOIN fact_sales fs ON fs.date_key = d.date_key
LEFT JOIN fact_payments fp ON fp.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name) t
WHERE gross_premium IS NOT NULL AND collected IS NOT NULL""")

Q["premium_share"] = with_ctes(["fact_sales"], f"""
SELECT policy_type, cnt AS count, CAST(ROUND(p, 2) AS DOUBLE) AS total_premium,
       CAST(CAST({rdiv('cnt * 1000', 'SUM(cnt) OVER ()')} AS DECIMAL(38,0)) * 0.1 AS DOUBLE) AS count_share_pct,
       CAST(CAST({rdiv('p * 1000', 'SUM(p) OVER ()')} AS DECIMAL(38,0)) * 0.1 AS DOUBLE) AS premium_share_pct
FROM (SELECT policy_type, COUNT(*) AS cnt, SUM(premium_amount) AS p FROM fact_sales GROUP BY policy_type) t""")

Q["payment_share"] = with_ctes(["fact_payments"], f"""
SELECT payment_method, payments, CAST(t AS DOUBLE) AS total_collected,
       CAST(CAST({rdiv('t * 100000', 'SUM(t) OVER () * 100')} AS DECIMAL(38,0)) * 0.1 AS DOUBLE) AS share_pct,
       CAST(SUM(t) OVER () AS DOUBLE) AS grand_total
FROM (SELECT payment_method, COUNT(*) AS payments, SUM(payment_amount) AS t
      FROM fact_payments WHERE payment_status = 'Completed' GROUP BY payment_method) x""")

Q["loss_ratio_tier"] = with_ctes(["fact_sales", "fact_claims", "dim_policy_type"], f"""
SELECT policy_type, loss_ratio_pct,
       CASE WHEN loss_ratio_pct > 100 THEN 'danger' WHEN loss_ratio_pct > 70 THEN 'warning' ELSE 'success' END AS tier,
       CAST(loss_ratio_pct AS VARCHAR) || '%' AS label
FROM (
  SELECT policy_type,
         CAST(CAST({rdiv('a * 1000000', 'p * 100')} AS DECIMAL(38,0)) * 0.01 AS DOUBLE) AS loss_ratio_pct
  FROM (SELECT pt.policy_type, ROUND(SUM(fs.premium_amount), 2) AS p, ROUND(SUM(fc.approved_amount), 2) AS a
        FROM dim_policy_type pt
        LEFT JOIN fact_sales fs ON fs.policy_type_id = pt.policy_type_id
        LEFT JOIN fact_claims fc ON fc.policy_type_id = pt.policy_type_id
        GROUP BY pt.policy_type) t) x""")

Q["label_positions"] = with_ctes(["fact_sales", "dim_county"], """
SELECT county_name, total_premium, max(total_premium) OVER () AS max_premium,
       ROUND(total_premium + max(total_premium) OVER () * 0.01, 2) AS label_at
FROM (SELECT dc.county_name, CAST(ROUND(SUM(fs.premium_amount), 2) AS DOUBLE) AS total_premium
      FROM fact_sales fs JOIN dim_county dc ON fs.county_id = dc.county_id GROUP BY dc.county_name) t""")

Q["money_labels"] = with_ctes(["fact_sales", "dim_county"], """
SELECT county_name, CAST(tp AS DOUBLE) AS total_premium,
       printf('KES %.2fM', CAST(tp AS DOUBLE) / 1000000) AS label_millions,
       CASE WHEN CAST(tp AS DOUBLE) >= 1000000 THEN printf('KES %.1fM', CAST(tp AS DOUBLE) / 1000000)
            WHEN CAST(tp AS DOUBLE) >= 1000 THEN printf('KES %.0fK', CAST(tp AS DOUBLE) / 1000)
            ELSE printf('KES %.0f', CAST(tp AS DOUBLE)) END AS axis_label
FROM (SELECT dc.county_name, ROUND(SUM(fs.premium_amount), 2) AS tp
      FROM fact_sales fs JOIN dim_county dc ON fs.county_id = dc.county_id GROUP BY dc.county_name) t""")

# ---- event feed ---------------------------------------------------------------
_STRICT = f"""
SELECT event_type,
       CASE event_type WHEN 'new_policy' THEN holder WHEN 'new_claim' THEN 'CLM-' || CAST(event_id AS VARCHAR)
                       ELSE 'PAY-' || CAST(event_id AS VARCHAR) END AS event_id,
       holder AS policy_id, CAST(amount AS DOUBLE) AS amount,
       CASE event_type WHEN 'new_policy' THEN {pick(['Nairobi', 'Mombasa', 'Kisumu', 'Nakuru', 'Eldoret', 'Thika', 'Malindi', 'Kitale', 'Garissa', 'Nyeri'], 'k')}
                       WHEN 'new_claim' THEN {pick(['Pending', 'Approved', 'Rejected', 'Under Review'], 'k')}
                       ELSE {pick(['M-Pesa', 'Bank Transfer', 'Credit Card', 'Cash'], 'k')} END AS extra_info,
       ts AS event_timestamp, {LOAD_TS} AS ingested_at
FROM events_msg WHERE event_type IN ('new_policy', 'new_claim', 'new_payment')"""

Q["events_strict"] = with_ctes(["events_msg"], _STRICT)

Q["events_lenient"] = with_ctes(["events_msg"], f"""
SELECT event_type,
       CASE event_type WHEN 'new_policy' THEN holder WHEN 'new_claim' THEN 'CLM-' || CAST(event_id AS VARCHAR)
                       WHEN 'new_payment' THEN 'PAY-' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_type IN ('new_policy', 'new_claim', 'new_payment') THEN holder ELSE '' END AS policy_id,
       CASE WHEN event_type = 'new_policy' THEN 'Customer ' || CAST(user_id AS VARCHAR) ELSE '' END AS customer_name,
       CAST(CASE WHEN event_type IN ('new_policy', 'new_claim', 'new_payment') THEN amount ELSE 0 END AS DOUBLE) AS amount,
       CASE event_type WHEN 'new_policy' THEN {pick(['Nairobi', 'Mombasa', 'Kisumu', 'Nakuru', 'Eldoret', 'Thika', 'Malindi', 'Kitale', 'Garissa', 'Nyeri'], 'k')}
                       WHEN 'new_claim' THEN {pick(['Pending', 'Approved', 'Rejected', 'Under Review'], 'k')}
                       WHEN 'new_payment' THEN {pick(['M-Pesa', 'Bank Transfer', 'Credit Card', 'Cash'], 'k')}
                       ELSE '' END AS extra_info,
       ts AS event_timestamp, {LOAD_TS} AS ingested_at
FROM events_msg""")

Q["event_totals"] = with_ctes(["events_msg"], """
SELECT event_type, COUNT(*) AS events, CAST(SUM(amount) AS DOUBLE) AS total_value
FROM events_msg WHERE event_type IN ('new_policy', 'new_claim', 'new_payment') GROUP BY event_type""")

Q["event_quarantine"] = """
SELECT CASE event_type WHEN 'signup' THEN 'new_policy' WHEN 'error' THEN 'new_claim'
            WHEN 'purchase' THEN 'new_payment' ELSE event_type END AS key, event_id AS seq,
       CASE event_id % 97 WHEN 1 THEN 'broken message ' || event_id
            ELSE '{"event_type": "' || CASE event_type WHEN 'signup' THEN 'new_policy' WHEN 'error' THEN 'new_claim'
                 WHEN 'purchase' THEN 'new_payment' ELSE event_type END END AS raw_value
FROM events WHERE event_id % 97 < 2"""

Q["event_lines"] = with_ctes(["events_msg"], """
SELECT event_id AS place, event_type, CAST(a AS DOUBLE) AS amount, 'KES ' || format('{:,.2f}', CAST(a AS DOUBLE)) AS label
FROM (SELECT *, CASE WHEN event_type IN ('new_policy', 'new_claim', 'new_payment') THEN amount ELSE 0 END AS a
      FROM events_msg WHERE event_id % 97 > 1)""")


def oracle_sql() -> dict[str, str]:
    return dict(Q)
