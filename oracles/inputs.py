"""Logical inputs over the benchmark tables."""

from __future__ import annotations

from oracles.base import cte, minus_months, minus_weeks, week_of

CENTRES = "('MC901','MC902','MC903','MC904','MC905')"

cte("cal", "", f"""
  SELECT d AS week_starts, {week_of('d')} AS week_no, year(d)::INTEGER AS yr, month(d)::INTEGER AS fm_month,
         (year(d) * 100 + month(d))::INTEGER AS yearmonth
  FROM (SELECT unnest(generate_series(date_trunc('week', min(o_orderdate)), date_trunc('week', max(o_orderdate)),
               INTERVAL 7 DAY))::DATE AS d FROM orders)""")

cte("run", "cal", f"""
  SELECT cur, {minus_weeks('cur', 2)} AS cutoff, {minus_weeks('cur', 9)} AS recent, {minus_weeks('cur', 52)} AS act_lo,
         {minus_weeks('cur', 104)} AS hist_lo, cur_month, {minus_months('cur_month', 12)} AS prod_lo
  FROM (SELECT cur, (SELECT yearmonth FROM cal WHERE week_no = cur) AS cur_month FROM
    (SELECT min(w) AS cur FROM (
       SELECT o_orderpriority IN ('1-URGENT','2-HIGH') AS a, max(week_no) AS w
       FROM orders JOIN cal ON week_starts = date_trunc('week', o_orderdate)::DATE GROUP BY 1)))""")

cte("acct", "", """
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 97 <> 96 THEN 'P' || lpad((c_custkey // 10)::VARCHAR, 10, '0') END AS parentname,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'OTHER' ELSE 'NAT' END AS lob,
         CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal < 3000 THEN 'B.1-11 trucks' WHEN c_acctbal < 5000 THEN 'F.101-250 trucks'
              WHEN c_acctbal < 6000 THEN 'H.Over 500 trucks' ELSE 'A.express check account' END AS num_of_trucks,
         CASE WHEN c_nationkey <> 0 THEN (['ca','TX','FL','OH','IL','GA','MO','NC','TN','PA','AZ','NV','WA'])[c_nationkey % 13 + 1] END AS state_code,
         300 + floor(abs(c_acctbal) / 15)::BIGINT AS credit_score,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 0 ELSE floor(abs(c_acctbal))::BIGINT END AS credit_limit,
         CASE WHEN c_custkey % 5 <> 0 THEN '555-' || c_custkey::VARCHAR END AS phone
  FROM customer""")

cte("trx", "", """
  SELECT o_custkey AS customer_id, o_orderdate::DATE AS trx_date,
         o_orderpriority IN ('1-URGENT','2-HIGH') AS is_a,
         l_suppkey % 10 AS card, l_suppkey % 50 = 0 AS excluded,
         p_type IN ('SMALL','MEDIUM','LARGE') AS fuel, l_extendedprice AS spend, l_quantity AS gallons,
         l_extendedprice * l_discount AS discount, l_tax, l_linenumber, l_linestatus, p_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

cte("wtrx", "trx cal", """
  SELECT trx.*, week_no AS week, yearmonth FROM trx LEFT JOIN cal ON week_starts = date_trunc('week', trx_date)::DATE""")

cte("active", "wtrx acct run", """
  SELECT DISTINCT w.customer_id FROM wtrx w JOIN acct a ON a.customer_id = w.customer_id CROSS JOIN run
  WHERE lob = 'NAT' AND week BETWEEN act_lo AND cur AND (is_a OR NOT excluded)""")

cte("spine", "active cal run", """
  SELECT customer_id, week_no AS week, yearmonth AS month FROM active CROSS JOIN cal CROSS JOIN run
  WHERE week_no BETWEEN hist_lo AND cur""")

cte("rows_a", "wtrx acct run", """
  SELECT w.customer_id, week, trx_date, CASE WHEN fuel THEN gallons ELSE 0.0 END AS total_gallons,
         CASE WHEN fuel THEN spend END AS fuel_spend, CASE WHEN NOT fuel THEN spend END AS nonfuel_spend, spend AS total_spend,
         CASE WHEN fuel THEN 1 ELSE 0 END AS fuel_trx, CASE WHEN fuel THEN 0 ELSE 1 END AS nonfuel_trx,
         discount AS total_discount
  FROM wtrx w JOIN acct USING (customer_id) CROSS JOIN run
  WHERE is_a AND card > 3 AND lob = 'NAT' AND week BETWEEN hist_lo AND cur""")

cte("rows_b", "wtrx acct run", """
  SELECT w.customer_id, week, trx_date, CASE WHEN fuel THEN gallons ELSE 0.0 END AS total_gallons,
         CASE WHEN fuel THEN spend ELSE 0.0 END AS fuel_spend, CASE WHEN NOT fuel THEN spend ELSE 0.0 END AS nonfuel_spend, spend AS total_spend,
         CASE WHEN fuel THEN 1 ELSE 0 END AS fuel_trx, CASE WHEN fuel THEN 0 ELSE 1 END AS nonfuel_trx,
         discount AS total_discount
  FROM wtrx w JOIN acct USING (customer_id) CROSS JOIN run
  WHERE NOT is_a AND NOT excluded AND lob = 'NAT' AND week BETWEEN hist_lo AND cur""")

cte("fuel_stats", "rows_a rows_b", """
  SELECT customer_id, week, round(coalesce(sum(total_gallons), 0), 6) AS total_gallons,
         coalesce(sum(fuel_trx), 0)::BIGINT AS total_fuel_trx, coalesce(sum(nonfuel_trx), 0)::BIGINT AS total_nonfuel_trx,
         coalesce(sum(fuel_trx + nonfuel_trx), 0)::BIGINT AS total_num_trx,
         round(coalesce(sum(fuel_spend), 0), 6) AS total_fuel_spend, round(coalesce(sum(nonfuel_spend), 0), 6) AS total_nonfuel_spend,
         round(coalesce(sum(total_spend), 0), 6) AS total_spend, round(coalesce(sum(total_discount), 0), 6) AS total_discount
  FROM (SELECT * FROM rows_a UNION ALL SELECT * FROM rows_b) GROUP BY 1, 2""")


def channel(name: str, card: int, column: str, extra: str = "") -> None:
    cte(name, "wtrx active run", f"""
  SELECT customer_id, week, round(sum(spend), 6) AS {column}{extra}
  FROM wtrx JOIN active USING (customer_id) CROSS JOIN run
  WHERE is_a AND card = {card} AND week BETWEEN hist_lo AND cur GROUP BY 1, 2""")


channel("express_check", 3, "total_comcheck_spend")
channel("virtual_check", 1, "total_vcomcheckspend")
channel("vcap", 2, "total_vcap_spend")
channel("ecash", 0, "total_ecashspend", ", round(sum(CASE WHEN fuel THEN gallons ELSE 0.0 END), 6) AS ecash_gallons")

cte("platform_fee", "wtrx active run", """
  SELECT customer_id, week, round(sum(rate), 6) AS fleet_transaction_fee, count(*) FILTER (rate > 0) AS num_of_fleet_fees_applied
  FROM (SELECT *, (CASE WHEN fuel THEN l_tax ELSE 0 END) + (CASE WHEN l_linenumber = 1 THEN 0.5 ELSE 0 END)::DOUBLE
                + (CASE WHEN l_linestatus = 'O' THEN 0.25 ELSE 0 END)::DOUBLE AS rate FROM wtrx WHERE NOT is_a)
  JOIN active USING (customer_id) CROSS JOIN run WHERE week BETWEEN hist_lo AND cur GROUP BY 1, 2""")

# Ledger: the fee a line stands for, the day that dates it and the signed amount.
cte("ledger", "", """
  SELECT o_custkey AS customer_id,
         CASE WHEN p_size <= 3 THEN 'equipment' WHEN l_linenumber = 1 THEN 'late' WHEN l_linenumber = 2 THEN 'risk'
              WHEN l_linenumber = 3 THEN 'optional' WHEN l_linenumber = 4 THEN 'proximity' WHEN l_linenumber = 5 THEN 'fleet_advance'
              WHEN l_linenumber = 6 THEN 'card' WHEN l_linestatus = 'O' THEN 'inactivity' ELSE 'check_admin' END AS fee,
         CASE WHEN p_size > 3 AND l_linenumber = 1 THEN l_shipdate ELSE o_orderdate END::DATE AS fee_date,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax ELSE -(l_extendedprice * l_tax) END AS amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

cte("wledger", "ledger cal run active", """
  SELECT l.customer_id, fee, week_no AS week, amt FROM ledger l JOIN active USING (customer_id)
  JOIN cal ON week_starts = date_trunc('week', fee_date)::DATE CROSS JOIN run WHERE week_no BETWEEN hist_lo AND cur""")

FEES = {
    "late": ("late_interest_fee_amount", "late_interest_fee_refund", "num_of_late_fees_applied", "num_of_late_fees_refunded"),
    "risk": ("risk_based_pricing_amount", "risk_based_pricing_refund", "num_of_risk_fees_applied", "num_of_risk_fees_refunded"),
    "optional": ("optional_program_amount", "optional_program_refund", "num_of_optional_fees_applied", "num_of_optional_fees_refunded"),
    "proximity": ("proximity_fee_amount", "proximity_fee_refund", "num_of_prox_fees_applied", "num_of_prox_fees_refunded"),
    "fleet_advance": ("fleet_advance_fee_amount", "fleet_advance_refund", "num_of_fleet_adv_applied", "num_of_fleet_adv_refunded"),
    "card": ("card_fee_amount", "card_fee_refund", "num_of_card_fees_applied", "num_of_card_fees_refunded"),
    "inactivity": ("inactivity_fee_amount", "inactivity_fee_refund", "num_of_inac_fees_applied", "num_of_inac_fees_refunded"),
    "check_admin": ("check_admin_amount", "check_admin_refund", "num_of_admin_fees_applied", "num_of_admin_fees_refunded"),
    "equipment": ("eld_equi_fee_amount", "eld_equi_fee_refund", "num_of_eld_eqi_fees_applied", "num_of_eld_eqi_fees_refunded"),
}
EXPRESS = ("express_fee_amount", "express_fee_refund", "num_of_expr_fees_applied", "num_of_expr_fees_refunded")

for _fee, (_a, _r, _n, _m) in FEES.items():
    cte(f"fee_{_fee}", "wledger", f"""
  SELECT customer_id, week, round(coalesce(sum(CASE WHEN amt < 0 THEN -amt ELSE 0 END), 0), 6) AS {_a},
         round(coalesce(sum(CASE WHEN amt > 0 THEN -amt ELSE 0 END), 0), 6) AS {_r},
         count(CASE WHEN amt < 0 THEN 1 END) AS {_n}, count(CASE WHEN amt > 0 THEN 1 END) AS {_m}
  FROM wledger WHERE fee = '{_fee}' GROUP BY 1, 2""")

cte("fee_express", "cal run active", f"""
  SELECT customer_id, week, round(sum(CASE WHEN amt > 0 THEN amt ELSE 0 END), 6) AS {EXPRESS[0]},
         round(sum(CASE WHEN amt < 0 THEN amt ELSE 0 END), 6) AS {EXPRESS[1]},
         count(CASE WHEN amt > 0 THEN 1 END) AS {EXPRESS[2]}, count(CASE WHEN amt < 0 THEN 1 END) AS {EXPRESS[3]}
  FROM (SELECT o_custkey AS customer_id, week_no AS week, CASE WHEN o_orderstatus = 'P' THEN -(o_totalprice * 0.001::DOUBLE) ELSE o_totalprice * 0.001::DOUBLE END AS amt
        FROM orders JOIN cal ON week_starts = date_trunc('week', o_orderdate)::DATE CROSS JOIN run
        WHERE o_orderkey % 10 <> 9 AND week_no BETWEEN hist_lo AND cur)
  JOIN active USING (customer_id) GROUP BY 1, 2""")


def _sum(columns: list[str]) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in columns)


SINGLE = [FEES[f] for f in ("late", "risk", "optional", "proximity")]
PROGRAM = [FEES[f] for f in ("fleet_advance", "card")]
OTHER = [FEES[f] for f in ("inactivity", "check_admin", "equipment")] + [EXPRESS]
ALL_FEES = SINGLE + PROGRAM + OTHER
TRX = ["total_gallons", "total_fuel_trx", "total_nonfuel_trx", "total_num_trx", "total_fuel_spend", "total_nonfuel_spend", "total_spend", "total_discount"]
CHANNELS = ["total_comcheck_spend", "total_vcomcheckspend", "total_vcap_spend", "total_ecashspend", "ecash_gallons"]
PUBLIC_FEES = ([c for f in ("late", "risk", "optional", "proximity", "fleet_advance") for c in FEES[f]]
               + [c for f in ("card", "inactivity", "check_admin", "equipment") for c in FEES[f][2:]] + list(EXPRESS[2:]))
DERIVED = {
    "program_fee_amount": f"round({_sum([f[0] for f in PROGRAM] + ['fleet_transaction_fee'])}, 6)",
    "program_fee_refund": f"round({_sum([f[1] for f in PROGRAM])}, 6)",
    "other_fees_amount": f"round({_sum([f[0] for f in OTHER])}, 6)",
    "other_fees_refund": f"round({_sum([f[1] for f in OTHER])}, 6)",
    "tot_fee_amount": f"round({_sum([f[0] for f in ALL_FEES] + ['fleet_transaction_fee'])}, 6)",
    "tot_fee_refund": f"round({_sum([f[1] for f in ALL_FEES])}, 6)",
    "num_of_program_fees_applied": f"({_sum([f[2] for f in PROGRAM] + ['num_of_fleet_fees_applied'])})",
    "num_of_program_fees_refunded": f"({_sum([f[3] for f in PROGRAM])})",
    "num_of_other_fees_applied": f"({_sum([f[2] for f in OTHER])})",
    "num_of_other_fees_refunded": f"({_sum([f[3] for f in OTHER])})",
}
MEASURES = TRX + CHANNELS + ["num_of_fleet_fees_applied"] + PUBLIC_FEES + list(DERIVED)
_SOURCES = ["fuel_stats", "platform_fee", *[f"fee_{f}" for f in FEES], "fee_express", "express_check", "virtual_check", "vcap", "ecash"]

cte("fact", "spine " + " ".join(_SOURCES), f"""
  SELECT s.customer_id, s.week, {', '.join(TRX + CHANNELS + ['num_of_fleet_fees_applied'] + PUBLIC_FEES)},
         {', '.join(f'{v} AS {k}' for k, v in DERIVED.items())}
  FROM spine s {' '.join(f'LEFT JOIN {x} USING (customer_id, week)' for x in _SOURCES)}""")

cte("weekly", "fact acct", f"""
  SELECT parentname, week,
         {', '.join(f'sum(coalesce({m}, 0))::BIGINT AS {m}' if m.startswith('num_of') or m in ('total_fuel_trx', 'total_nonfuel_trx', 'total_num_trx') else f'round(sum(coalesce({m}, 0)), 6) AS {m}' for m in MEASURES)}
  FROM fact JOIN acct USING (customer_id) WHERE parentname IS NOT NULL GROUP BY 1, 2""")

# Labelled weeks --------------------------------------------------------------
ACTIVE = ("(total_gallons > 0 OR total_nonfuel_spend <> 0 OR total_ecashspend <> 0 OR total_vcomcheckspend <> 0"
          " OR total_comcheck_spend <> 0 OR total_vcap_spend <> 0)")

cte("enough", "weekly", f"SELECT parentname, count(*) AS active_weeks FROM weekly WHERE {ACTIVE} GROUP BY 1 HAVING count(*) >= 13")

cte("bounds", "weekly enough", f"""
  SELECT parentname, min(week) AS min_lifetime_week, max(week) AS max_lifetime_week
  FROM weekly JOIN enough USING (parentname) WHERE {ACTIVE} GROUP BY 1""")

cte("trimmed", "weekly bounds", """
  SELECT weekly.*, min_lifetime_week, max_lifetime_week FROM weekly JOIN bounds USING (parentname)
  WHERE week >= min_lifetime_week AND week <= max_lifetime_week""")


def label(n: int, offset: int = 0) -> str:
    two = f" WHEN week_rank BETWEEN {n + 1 + offset} AND {2 * n + offset} THEN 'range-2'" if n < 52 else ""
    return f"CASE WHEN week_rank BETWEEN {1 + offset} AND {n + offset} THEN 'range-1'{two} END AS week_range_{n}"


cte("labelled", "trimmed", f"""
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY parentname) AS rows_kept FROM (
    SELECT *, {', '.join(label(n) for n in (4, 8, 13, 26, 52))}
    FROM (SELECT *, row_number() OVER (PARTITION BY parentname ORDER BY week DESC)::INTEGER AS week_rank FROM trimmed)
    WHERE week_rank <= 52)) WHERE rows_kept >= 13""")
