"""Profile, static features, cases, surveys and prioritisation inputs."""

from __future__ import annotations

from oracles.base import cte, week_of

TYPES = {"SMALL": "FUEL", "MEDIUM": "MASTERCARD", "LARGE": "PROPRIETARY", "ECONOMY": "ECASH", "STANDARD": "EXPRESS CHECK", "PROMO": "NON-CORE"}
PRODUCT = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END"

cte("last_trx", "wtrx acct run", """
  SELECT w.customer_id, max(week) AS last_transaction_week, max(yearmonth) AS last_transaction_month,
         CASE WHEN max(yearmonth) > max(cur_month) THEN max(cur_month) ELSE max(yearmonth) END::INTEGER AS trimmed_last_month
  FROM wtrx w JOIN acct USING (customer_id) CROSS JOIN run WHERE lob = 'NAT' AND (is_a OR NOT excluded) GROUP BY 1""")

cte("volumes", "wtrx run", """
  SELECT customer_id, round(sum(CASE WHEN fuel THEN gallons ELSE 0 END), 6) AS volume, round(sum(spend), 6) AS total_spend, count(*) AS total_num_trx
  FROM wtrx CROSS JOIN run WHERE (is_a OR NOT excluded) AND week BETWEEN act_lo AND cur GROUP BY 1""")

cte("terms", "", """
  SELECT customer_id, billing_freq, due_days FROM (
    SELECT o_custkey AS customer_id, CASE o_orderstatus WHEN 'F' THEN 'daily' WHEN 'O' THEN 'weekly' WHEN 'P' THEN 'monthly' END AS billing_freq,
           l_quantity::BIGINT AS due_days,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE rn = 1""")

cte("latest_order", "", """
  SELECT customer_id, d, k FROM (
    SELECT o_custkey AS customer_id, left(o_orderpriority, 1) AS d, o_orderkey AS k,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")

cte("channels", "latest_order", """
  SELECT customer_id, CASE d WHEN '1' THEN 'Inbound' WHEN '2' THEN 'Outbound' WHEN '3' THEN 'Field' WHEN '4' THEN 'Unk' ELSE 'Regional Sales' END AS channel_1,
         CASE d WHEN '1' THEN 'National' WHEN '2' THEN 'Strategic' WHEN '3' THEN 'Account Mgmt' WHEN '4' THEN 'Telesales' ELSE 'Other' END AS channel_2
  FROM latest_order""")

cte("pay", "latest_order", """
  SELECT customer_id, CASE d WHEN '1' THEN 'CustACH' WHEN '2' THEN 'EBP/FIS' WHEN '3' THEN 'WesternUnion' WHEN '4' THEN 'Wire'
         ELSE CASE WHEN k % 2 = 0 THEN 'CDN/ACH' ELSE 'Check' END END AS last_payment_method FROM latest_order""")

cte("revenue", "run", f"""
  SELECT customer_id, producttype, netspend FROM (
    SELECT o_custkey AS customer_id, {PRODUCT} AS producttype, l_extendedprice AS netspend,
           (year(o_orderdate) * 100 + month(o_orderdate)) AS ym
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) CROSS JOIN run WHERE ym BETWEEN prod_lo AND cur_month""")

cte("top6", "revenue", f"""
  SELECT customer_id, {', '.join(f'max(producttype) FILTER (rn = {n}) AS product_information_{n}' for n in range(1, 7))}
  FROM (SELECT customer_id, producttype, row_number() OVER (PARTITION BY customer_id ORDER BY f DESC, producttype) AS rn
        FROM (SELECT customer_id, producttype, count(*) AS f FROM revenue GROUP BY 1, 2)) GROUP BY 1""")

SPENDS = {"ECASH": "total_ecashspend", "EXPRESS CHECK": "total_expresscheckspend", "MASTERCARD": "total_mastercardspend",
          "PROPRIETARY": "total_proprietaryspend", "FUEL": "total_fuelspend", "NON-CORE": "total_non_corespend"}
cte("spend6", "revenue", f"""
  SELECT customer_id, {', '.join(f"round(coalesce(sum(CASE WHEN producttype = '{t}' THEN netspend END), 0), 6)::DOUBLE AS {c}" for t, c in SPENDS.items())}
  FROM revenue GROUP BY 1""")

PI = ", ".join(f"product_information_{n}" for n in range(1, 7))
cte("profile", "active volumes last_trx acct terms channels pay top6 spend6 run", f"""
  SELECT customer_id, parentname, volume, v.total_spend, v.total_num_trx, first_trx_month, last_transaction_week, last_transaction_month,
         state_code, num_of_trucks, CASE WHEN credit_limit > 0 THEN credit_limit END AS credit_limit, billing_freq, due_days, channel_1, channel_2, credit_score,
         {PI}, round({' + '.join(f'coalesce({c}, 0)' for c in SPENDS.values())}, 6) AS total_producttype_spend,
         CASE WHEN last_transaction_week > cutoff THEN 'ACTIVE' ELSE 'CHURNER' END AS churn_flag, last_payment_method
  FROM active LEFT JOIN volumes v USING (customer_id) LEFT JOIN last_trx USING (customer_id) JOIN acct USING (customer_id)
  LEFT JOIN (SELECT o_custkey AS customer_id, min(year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS first_trx_month FROM orders GROUP BY 1) USING (customer_id)
  LEFT JOIN terms USING (customer_id) LEFT JOIN channels USING (customer_id) LEFT JOIN pay USING (customer_id)
  LEFT JOIN top6 USING (customer_id) LEFT JOIN spend6 USING (customer_id) CROSS JOIN run WHERE parentname IS NOT NULL""")

PICK = ("customer_id, volume, total_spend, total_num_trx, last_transaction_month, state_code, num_of_trucks, billing_freq, due_days,"
        f" channel_1, channel_2, credit_score, {PI}, last_payment_method")
cte("pprofile", "profile run", f"""
  SELECT parentname, accounts, {PICK},
         CASE WHEN accounts > 1 THEN coalesce(limits, 0) ELSE limits END::BIGINT AS credit_limit, first_m AS first_trx_month, last_w AS last_transaction_week,
         spend_max AS total_producttype_spend, CASE WHEN last_w > cutoff THEN 'ACTIVE' ELSE 'CHURNER' END AS churn_flag
  FROM (SELECT *, count(*) OVER p AS accounts, sum(credit_limit) OVER p AS limits, min(first_trx_month) OVER p AS first_m,
               max(last_transaction_week) OVER p AS last_w, max(total_producttype_spend) OVER p AS spend_max,
               row_number() OVER (PARTITION BY parentname ORDER BY volume DESC NULLS LAST, total_num_trx DESC NULLS LAST, last_transaction_week DESC NULLS LAST, customer_id) AS rn
        FROM profile WINDOW p AS (PARTITION BY parentname)) CROSS JOIN run WHERE rn = 1""")

CHANNEL = """CASE WHEN t LIKE '%inbound%' THEN 'inbound' WHEN t LIKE '%outbound%' THEN 'outbound' WHEN t LIKE '%field%' THEN 'field'
  WHEN t LIKE '%telesales%' THEN 'outbound' WHEN t LIKE '%regional%' OR t LIKE '%national%' OR t LIKE '%strategic%' OR t LIKE '%account mgmt%' THEN 'strategic/AM'
  WHEN t LIKE '%unknown%' THEN 'unknown' ELSE 'others' END"""
CHANNEL_TEXT = "lower(coalesce(CASE WHEN channel_1 <> 'Unk' THEN channel_1 END, channel_2, 'unknown'))"
GRADE = """CASE WHEN credit_score IS NULL OR credit_score <= -1 THEN 'UNK' WHEN credit_score <= 300 THEN 'Worse' WHEN credit_score <= 579 THEN 'Poor'
  WHEN credit_score <= 669 THEN 'Fair' WHEN credit_score <= 739 THEN 'Good' WHEN credit_score <= 799 THEN 'Very-Good' ELSE 'Excellent' END"""
COMBOS = {
    "ECASH_ONLY": "ECASH", "ECASH_COMCHECK": "ECASH_EXPRESS CHECK",
    "ECASH_COMCHECK_FUEL": "ECASH_EXPRESS CHECK_FUEL|ECASH_EXPRESS CHECK_FUEL_MASTERCARD|ECASH_EXPRESS CHECK_FUEL_PROPRIETARY|ECASH_EXPRESS CHECK_PROPRIETARY",
    "ECASH_FUEL": "ECASH_FUEL|ECASH_FUEL_MASTERCARD|ECASH_FUEL_PROPRIETARY|ECASH_MASTERCARD|ECASH_PROPRIETARY",
    "COMCHECK_ONLY": "EXPRESS CHECK",
    "COMCHECK_FUEL": "EXPRESS CHECK_FUEL|EXPRESS CHECK_FUEL_MASTERCARD|EXPRESS CHECK_FUEL_MASTERCARD_PROPRIETARY|EXPRESS CHECK_MASTERCARD|EXPRESS CHECK_FUEL_PROPRIETARY|EXPRESS CHECK_PROPRIETARY",
    "FUEL_ONLY": "FUEL|FUEL_MASTERCARD|FUEL_MASTERCARD_PROPRIETARY|FUEL_PROPRIETARY|MASTERCARD_PROPRIETARY|PROPRIETARY|MASTERCARD",
}
BUCKET = "CASE " + " ".join(
    f"WHEN combination IN ({', '.join(repr(x) for x in v.split('|'))}) THEN '{k}'" for k, v in COMBOS.items()) + " ELSE 'OTHERS' END"


def combination(n: int) -> str:
    items = ", ".join(f"product_information_{k}" for k in range(1, n + 1))
    return f"array_to_string(list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL AND x <> 'NON-CORE'))), '_')"


cte("medians", "pprofile", """
  SELECT median(first_trx_month) AS fm, quantile_disc(first_trx_month, 0.5) AS fm_lo, median(due_days) AS dd, median(credit_limit) AS cl FROM pprofile""")
cte("medians2", "pprofile medians", "SELECT median(coalesce(credit_limit, cl)) AS cl2 FROM pprofile CROSS JOIN medians")
cte("last_w", "labelled cal", """
  SELECT parentname, week, yearmonth FROM (SELECT parentname, max(week) AS week FROM labelled GROUP BY 1) LEFT JOIN cal ON week_no = week""")

TRUCKS = "lower(coalesce(num_of_trucks, 'unknown'))"
cte("static", "pprofile medians medians2 last_w", f"""
  SELECT *, CASE WHEN tenure <= 1 THEN 'NEW' ELSE 'EXISTING' END AS customer_segment FROM (
  SELECT parentname, first_trx_month, last_transaction_week, last_transaction_month, state_code, num_of_trucks, credit_limit, billing_freq, due_days, credit_grade,
         round_even(datediff('day', make_date(first_trx_month // 100, first_trx_month % 100, 1), make_date(yearmonth // 100, yearmonth % 100, 1)) / 365, 2) AS tenure,
         {CHANNEL} AS channel, {BUCKET} AS product_type_most_frequent, churn_flag,
         CASE num_of_trucks WHEN 'b.1-11 trucks' THEN 'small' WHEN 'f.101-250 trucks' THEN 'medium' WHEN 'h.over 500 trucks' THEN 'large' ELSE 'others' END AS customer_size,
         last_payment_method
  FROM (SELECT parentname, coalesce(first_trx_month, CASE WHEN fm = floor(fm) AND fm::BIGINT % 100 BETWEEN 1 AND 12 THEN fm::INTEGER ELSE fm_lo END) AS first_trx_month,
               last_transaction_week, last_transaction_month,
               CASE WHEN state_code IS NULL THEN 'UNK' WHEN upper(state_code) IN ('CA','TX','FL','OH','IL','GA','MO','NC','TN','PA') THEN upper(state_code) ELSE 'OTHERS' END AS state_code,
               CASE WHEN {TRUCKS} IN ('b.1-11 trucks','f.101-250 trucks','h.over 500 trucks','unknown') THEN {TRUCKS} ELSE 'others' END AS num_of_trucks,
               trunc(CASE WHEN coalesce(credit_limit, cl) = 0 THEN cl2 ELSE coalesce(credit_limit, cl) END)::BIGINT AS credit_limit,
               coalesce(billing_freq, 'unknown') AS billing_freq, trunc(coalesce(due_days, dd))::BIGINT AS due_days, {GRADE} AS credit_grade,
               {CHANNEL_TEXT} AS t, {combination(6)} AS combination, CASE WHEN churn_flag = 'ACTIVE' THEN 0 ELSE 1 END AS churn_flag,
               coalesce(last_payment_method, 'unknown') AS last_payment_method, yearmonth
        FROM pprofile JOIN last_w USING (parentname) CROSS JOIN medians CROSS JOIN medians2))""")

# Cases and surveys -----------------------------------------------------------
SPREAD = """
  SELECT event_id, event_type, value, event_id % (SELECT max(c_custkey) + 1 FROM customer) AS customer_id,
         (SELECT max(o_orderdate)::DATE FROM orders) - (7 * ((event_id // 5) % 104))::INTEGER AS created
  FROM events"""
cte("cases_raw", "", f"""
  SELECT customer_id, created AS created_date,
         CASE event_type WHEN 'error' THEN 'Tech  Support' WHEN 'click' THEN 'Online System Inquiry' WHEN 'view' THEN 'Billing & Payments'
              WHEN 'purchase' THEN 'Transaction' WHEN 'signup' THEN 'Account  Maintenance' END AS type,
         CASE WHEN floor(value)::BIGINT % 17 = 0 THEN 'High  Risk' END AS subtype, (floor(value)::BIGINT % 6)::INTEGER AS status_changes
  FROM ({SPREAD})""")
cte("cases", "cases_raw active acct cal run", """
  SELECT DISTINCT customer_id, parentname, week_no AS call_week, type, subtype, status_changes, created_date
  FROM cases_raw JOIN active USING (customer_id) JOIN acct USING (customer_id)
  JOIN cal ON week_starts = date_trunc('week', created_date)::DATE CROSS JOIN run
  WHERE parentname IS NOT NULL AND week_no BETWEEN hist_lo AND cur""")
GROUPED = """CASE WHEN subtype IS NOT NULL THEN 'fees' ELSE CASE type WHEN 'Tech  Support' THEN 'tech support' WHEN 'Online System Inquiry' THEN 'online system inquiry'
  WHEN 'Billing & Payments' THEN 'billing and payments' WHEN 'Transaction' THEN 'transactions' WHEN 'Account  Maintenance' THEN 'account details and maintenance' END END"""
KINDS = ["account details and maintenance", "card pin maintenance", "express check", "tech support", "billing and payments", "fees",
         "online system inquiry", "transactions", "close inquiry", "Others"]
cte("call_weekly", "cases", f"""
  SELECT parentname, call_week, count(*) AS statuschangeflag_count, count(*) FILTER (status_changes >= 3) AS statuschangeflag_sum,
         {', '.join(f"count(*) FILTER (k = '{k}') AS {k.lower().replace(' ', '_')}" for k in KINDS)}
  FROM (SELECT *, {GROUPED} AS k FROM cases) GROUP BY 1, 2""")

NPS = "CASE WHEN {r} >= 9 THEN 'Promoter' WHEN {r} <= 6 THEN 'Detractor' ELSE 'Passive' END"
cte("responses", "active acct cal run", f"""
  SELECT DISTINCT customer_id, parentname, issue_solved, product_rating, agent_rating, {NPS.format(r='product_rating')} AS product_nps,
         {NPS.format(r='agent_rating')} AS agent_nps, created AS case_response_dt, week_no AS case_week
  FROM (SELECT *, CASE WHEN floor(value)::BIGINT % 3 = 0 THEN 'Absolutely' ELSE 'Not yet' END AS issue_solved,
               (floor(value)::BIGINT % 11)::INTEGER AS product_rating, (floor(value / 2)::BIGINT % 11)::INTEGER AS agent_rating
        FROM ({SPREAD}) WHERE event_type IN ('purchase', 'signup'))
  JOIN active USING (customer_id) JOIN acct USING (customer_id) JOIN cal ON week_starts = date_trunc('week', created)::DATE CROSS JOIN run
  WHERE parentname IS NOT NULL AND week_no BETWEEN hist_lo AND cur""")
W = "PARTITION BY parentname, case_week"
cte("survey_rows", "responses", f"""
  SELECT *, CASE WHEN issue_solved = 'Absolutely' THEN 1 ELSE 0 END AS issuesolvedflag, count(*) OVER ({W}) AS issuesolved_all_count,
         count(*) FILTER (issue_solved = 'Absolutely') OVER ({W}) AS issuesolved_solved_count,
         CASE WHEN product_rating > 0 THEN sum(product_rating) FILTER (product_rating > 0) OVER ({W}) / count(*) FILTER (product_rating > 0) OVER ({W}) ELSE 0.0::DOUBLE END AS avg_product_rating,
         CASE WHEN agent_rating > 0 THEN sum(agent_rating) FILTER (agent_rating > 0) OVER ({W}) / count(*) FILTER (agent_rating > 0) OVER ({W}) ELSE 0.0::DOUBLE END AS avg_agent_rating,
         CASE WHEN product_rating > 0 THEN count(*) FILTER (product_rating > 0) OVER ({W}) ELSE 0 END AS productrating_cnt,
         CASE WHEN product_rating > 0 THEN count(agent_rating) FILTER (product_rating > 0) OVER ({W}) ELSE 0 END AS agentrating_cnt,
         {', '.join(f"CASE WHEN {a}_nps = '{b.capitalize()}' THEN count(*) FILTER ({a}_nps = '{b.capitalize()}') OVER ({W}) ELSE 0 END AS {a}_{b}_cnt" for a in ('product', 'agent') for b in ('promoter', 'detractor'))},
         count(*) OVER ({W}) AS total_counts
  FROM responses""")

# Prioritisation ---------------------------------------------------------------
cte("recent", "wtrx active run cal", """
  SELECT customer_id, week, yearmonth AS month, CASE WHEN fuel THEN gallons ELSE 0.0 END AS gallons, spend AS revenue,
         (SELECT count(*) FROM cal WHERE week_no > week) AS age
  FROM wtrx JOIN active USING (customer_id) CROSS JOIN run
  WHERE (is_a OR NOT excluded) AND week <= cur AND (SELECT count(*) FROM cal WHERE week_no > week) < 52""")


def yearly(key: str, side: str) -> str:
    cols = ", ".join(
        f"round(sum({m}), 6) AS last_52_weeks_{m}_{side}, round(sum({m}), 6) / 12 AS monthly_avg_{m}_last_52_weeks_{side},"
        f" max({m}) AS max_{m}_per_month_{side}, round(max({m}) * 12, 6) AS last_52_weeks_{m}_max_{side}" for m in ("gallons", "revenue"))
    return f"""SELECT {key}, {cols} FROM (SELECT {key}, month, round(sum(gallons), 6) AS gallons, round(sum(revenue), 6) AS revenue
      FROM recent JOIN acct USING (customer_id) WHERE parentname IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""


PROB = "round(('0x' || substr(md5('0:' || parentname), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 4)"
cte("combined", "recent acct cases cal", f"""
  SELECT parentname, customer_id AS acctcode, {PROB} AS prob, a.* EXCLUDE (customer_id), p.* EXCLUDE (parentname), l.* EXCLUDE (customer_id),
         coalesce(n_cases, 0) AS count_sf_cases_last3m, phone
  FROM ({yearly('customer_id', 'y')}) a JOIN acct USING (customer_id) JOIN ({yearly('parentname', 'x')}) p USING (parentname)
  JOIN (SELECT customer_id, max(week) AS last_transaction_week, max(month) AS last_transaction_month,
          {', '.join(f'round(coalesce(sum(gallons) FILTER (age < {n}), 0), 6)::DOUBLE AS last_{n}_weeks_gallons' for n in (4, 8, 13, 26))}
        FROM recent GROUP BY 1) l USING (customer_id)
  LEFT JOIN (SELECT customer_id, count(*) AS n_cases FROM cases WHERE created_date >= (SELECT max(week_starts) - 84 FROM cal) GROUP BY 1) USING (customer_id)""")

RANKED = ["last_52_weeks_gallons", "last_52_weeks_gallons_max", "last_52_weeks_revenue", "last_52_weeks_revenue_max"]
cte("pframe", "combined", f"""
  SELECT DISTINCT parentname, prob, {', '.join(f'{c}_x' for c in RANKED)} FROM combined WHERE last_52_weeks_gallons_x <> 0""")
cte("pct", "pframe", f"""
  SELECT parentname, prob, last_52_weeks_revenue_x, {', '.join(
    f'(rank() OVER (ORDER BY {c}_x) + (count(*) OVER (PARTITION BY {c}_x) - 1) / 2) / count(*) OVER () AS {c}_pct' for c in RANKED)}
  FROM pframe""")


def bin5(v: str) -> str:
    return (f"CASE WHEN {v} BETWEEN 0 AND 0.2 THEN '0-0.2' WHEN {v} > 0.2 AND {v} <= 0.4 THEN '0.2-0.4' WHEN {v} > 0.4 AND {v} <= 0.6 THEN '0.4-0.6'"
            f" WHEN {v} > 0.6 AND {v} <= 0.8 THEN '0.6-0.8' WHEN {v} > 0.8 AND {v} <= 1 THEN '0.8-1' END")


cte("prio", "pct", f"""
  SELECT *, dense_rank() OVER (ORDER BY priority_bin DESC, churn_prob_bin DESC)::INTEGER AS parent_rank FROM (
    SELECT *, {bin5('prob')} AS churn_prob_bin, {bin5('priority')} AS priority_bin, {bin5('last_52_weeks_revenue_pct')} AS revenue_bin
    FROM (SELECT *, prob * greatest({', '.join(f'{c}_pct' for c in RANKED)}) AS priority FROM pct))""")
