"""Feature families and modelling statistics."""

from __future__ import annotations

from oracles.base import cte

R = {4: "week_range_4 = 'range-1'", 8: "week_range_8 = 'range-1'", 13: "week_range_13 = 'range-1'", 26: "week_range_26 = 'range-1'", 52: "week_range_52 = 'range-1'"}
TRX = ["total_gallons", "total_fuel_trx", "total_nonfuel_trx", "total_fuel_spend", "total_nonfuel_spend", "total_num_trx",
       "total_comcheck_spend", "total_vcap_spend", "total_ecashspend", "ecash_gallons"]
SHARES = {"fuel": "total_gallons", "nonfuel": "total_nonfuel_spend", "trx": "total_num_trx", "comcheck_spend": "total_comcheck_spend",
          "vcap_spend": "total_vcap_spend", "ecash_spend": "total_ecashspend"}


def tail(n: int) -> str:
    return "" if n == 52 else str(n)


def rsum(v: str, where: str) -> str:
    return f"round(sum({v}) FILTER ({where}), 6)"


def div0(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({b}, 0) = 0 THEN 0 ELSE coalesce({a} / {b}, 0) END::DOUBLE"


def change(new: str, old: str) -> str:
    return f"CASE WHEN {old} = 0 THEN sign({new}) ELSE ({new} - {old}) / {old} END::DOUBLE"


_avg = [f"{div0(rsum(m, R[n]), f'count(*) FILTER ({R[n]} AND {m} <> 0)')} AS {m}_avg{tail(n)}" for m in TRX for n in R]
_share = [f"{div0(f'count(*) FILTER ({R[n]} AND {m} <> 0)', f'count(*) FILTER ({R[n]})')} AS share_active_{s}{n}" for s, m in SHARES.items() for n in (4, 8, 13, 26)]
_share += [f"{div0('count(*) FILTER (' + m + (' > 0' if s == 'fuel' else ' <> 0') + ')', 'count(*)')} AS share_active_{s}52" for s, m in SHARES.items()]
cte("trx_avg", "labelled", f"SELECT parentname, {', '.join(_avg + _share)} FROM labelled GROUP BY 1")


def scored(rows: str, names: list[str]) -> tuple[str, str]:
    """Edges as one row, and score expressions reading it."""
    edges = ", ".join(f"list_distinct(quantile_cont(nullif({n}_avg, 0), [0, 0.25, 0.5, 0.75, 1])) AS e_{n}" for n in names)
    scores = ", ".join(
        f"CASE WHEN {n}_avg = 0 OR coalesce(len(e_{n}), 0) < 2 THEN 0 ELSE greatest(1, len(list_filter(e_{n}, lambda x: x < {n}_avg))) END::INTEGER AS {n}_score" for n in names)
    return f"SELECT {edges} FROM {rows}", scores


_edges, TRX_SCORES = scored("trx_avg", TRX)
cte("trx_edges", "trx_avg", _edges)
TRX_CHANGES = [f'{change(f"{m}_avg4", f"{m}_avg{tail(n)}")} AS "{m}_ch_1-{n}_1-4"' for m in TRX for n in (8, 13, 26, 52)]
cte("trx_features", "trx_avg trx_edges", f"SELECT trx_avg.*, {TRX_SCORES}, {', '.join(TRX_CHANGES)} FROM trx_avg CROSS JOIN trx_edges")

# Fees ---------------------------------------------------------------------------
APPLIED = ["late_fees_applied", "risk_fees_applied", "optional_fees_applied", "fleet_adv_applied", "fleet_fees_applied", "inac_fees_applied",
           "admin_fees_applied", "expr_fees_applied", "eld_eqi_fees_applied", "card_fees_applied"]
REFUNDED = [a.replace("applied", "refunded") for a in APPLIED if a != "fleet_fees_applied"]
KINDS = "(" + " + ".join(f"(num_of_{a} > 0)::INTEGER" for a in APPLIED) + ")"
KINDS_BACK = "(" + " + ".join(f"(num_of_{a} > 0)::INTEGER" for a in REFUNDED) + ")"
RATES = ["late_interest_fee_amount", "risk_based_pricing_amount", "program_fee_amount", "optional_program_amount", "other_fees_amount", "total_discount"]
SHARE_FEES = ["risk_based_pricing_amount", "late_interest_fee_amount", "program_fee_amount", "optional_program_amount", "other_fees_amount"]
_base = [f"{rsum('total_gallons', R[n])} AS g{n}" for n in R]
_base += [f"{rsum(f, R[n])} AS s_{f}_{n}" for f in RATES for n in R]
_base += [f"coalesce(avg(k) FILTER (k > 0 AND {R[n]}), 0) AS unique_num_of_fees_avg{tail(n)}" for n in R]
_base += [f"{div0(f'count(*) FILTER ({R[n]} AND {f} <> 0)', f'count(*) FILTER ({R[n]})')} AS {f}_share_avg{tail(n)}" for f in SHARE_FEES for n in R]
for _n in (4, 8):
    for _name, _w in ((f"cents_p_gallon{_n}", R[_n]), (f"cents_p_gallon_before{_n}", f"coalesce(week_range_{_n}, '') <> 'range-1'")):
        _base.append(f"{rsum('tot_fee_amount', _w)} AS f_{_name}")
        _base.append(f"{rsum('total_gallons', _w)} AS g_{_name}")
cte("fee_base", "labelled", f"SELECT parentname, {', '.join(_base)} FROM (SELECT *, {KINDS} AS k FROM labelled) GROUP BY 1")
_rate = [f"{div0(f's_{f}_52', 'g52')} AS {f}_cents_p_gallon_avg" for f in RATES]
_over = []
for _n in (4, 8):
    for _name in (f"cents_p_gallon{_n}", f"cents_p_gallon_before{_n}"):
        _over.append(f"CASE WHEN g_{_name} <> 0 THEN f_{_name} / g_{_name} WHEN f_{_name} <> 0 THEN 0 END::DOUBLE AS {_name}")
cte("fee_avg", "fee_base", f"SELECT *, {', '.join(_rate + _over)} FROM fee_base")
FEE_SCORED = [f"{f}_cents_p_gallon" for f in RATES] + ["unique_num_of_fees"] + [f"{f}_share" for f in SHARE_FEES[:3]]
_edges, FEE_SCORES = scored("fee_avg", FEE_SCORED)
cte("fee_edges", "fee_avg", _edges)


# Literal infinity arithmetic: x/0 is signed infinity; in a change infinity becomes 1 and not-a-number 0.
cte("fee_rates", "fee_avg", "SELECT *, " + ", ".join(
    f"CASE WHEN g{k} <> 0 THEN s_{f}_{k} / g{k} WHEN s_{f}_{k} <> 0 THEN sign(s_{f}_{k}) * 'inf'::DOUBLE ELSE 0 END AS q_{f}_{k}"
    for f in RATES for k in R) + " FROM fee_avg")


def rate_change(f: str, n: int) -> str:
    a, b = f"q_{f}_4", f"q_{f}_{n}"
    return (f"CASE WHEN isinf({b}) THEN 0 WHEN isinf({a}) THEN sign({a}) * CASE WHEN {b} < 0 THEN -1 ELSE 1 END"
            f" WHEN {b} <> 0 THEN ({a} - {b}) / {b} ELSE sign({a}) END::DOUBLE")


FEE_CHANGES = [f'{rate_change(f, n)} AS "{f}_cents_p_gallon_ch_1-{n}_1-4"' for f in RATES for n in (8, 13, 26, 52)]
FEE_CHANGES += [f'{change(f"{f}_avg4", f"{f}_avg{tail(n)}")} AS "{f}_ch_1-{n}_1-4"' for f in FEE_SCORED[6:] for n in (8, 13, 26, 52)]
_kept = [f"{f}_avg" for f in FEE_SCORED] + [f"{f}_share_avg{n}" for f in SHARE_FEES for n in (4, 8, 13, 26)]
_names = ["cents_p_gallon4", "cents_p_gallon8", "cents_p_gallon_before4", "cents_p_gallon_before8"]
cte("fee_features", "fee_rates fee_edges", f"""
  SELECT parentname, {', '.join(_kept)}, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _names)}, {FEE_SCORES},
         {', '.join(f'(coalesce(cents_p_gallon{n} > cents_p_gallon_before{n}, false))::INTEGER AS max_cents_p_gallon{n}' for n in (4, 8))}, {', '.join(FEE_CHANGES)}
  FROM fee_rates CROSS JOIN fee_edges""")

FLAG_FEES = ["late_interest_fee", "program_fee", "optional_program", "risk_based_pricing", "other_fees"]
UP_TO = {n: f"week_rank <= {n}" for n in (4, 8, 13, 26, 52)}
_inner, _outer = [], []
for _f in FLAG_FEES:
    for _n, _w in UP_TO.items():
        _inner.append(f"count(*) FILTER ({_w} AND {_f}_amount <> 0) AS {_f}_inv_cnt{_n}")
        _inner.append(f"count(*) FILTER ({_w} AND {_f}_refund <> 0) AS {_f}_ref_cnt{_n}")
        _inner.append(f"{rsum(f'{_f}_amount', _w)} AS a_{_f}_{_n}")
        _inner.append(f"{rsum(f'{_f}_refund', _w)} AS r_{_f}_{_n}")
        _outer += [f"{_f}_inv_cnt{_n}", f"{_f}_ref_cnt{_n}"]
        _outer.append(f"CASE WHEN a_{_f}_{_n} <> 0 THEN -1 * (r_{_f}_{_n} / a_{_f}_{_n}) ELSE sign(-r_{_f}_{_n}) END::DOUBLE + 0.0 AS {_f}_refund_dollar_ratio{_n}")
        _outer.append(f"{div0(f'{_f}_ref_cnt{_n}', f'{_f}_inv_cnt{_n}')} AS {_f}_ref_incidence_ratio{_n}")
    for _n in (4, 8):
        _inner.append(f"count(*) FILTER (week_rank > {_n} AND {_f}_amount <> 0) AS b_{_f}_{_n}")
        _inner.append(f"count(*) FILTER (week_rank > {_n} AND week_rank <= {2 * _n} AND {_f}_amount <> 0) AS p_{_f}_{_n}")
        _outer.append(f"({_f}_inv_cnt{_n} >= 1 AND b_{_f}_{_n} = 0)::INTEGER AS {_f}_1st_{_n}")
        if _f == "late_interest_fee":
            _outer.append(f"({_f}_inv_cnt{_n} >= 2 AND b_{_f}_{_n} = 0)::INTEGER AS {_f}_2nd_{_n}")
        _outer.append(f"({_f}_inv_cnt{_n} = 0 AND p_{_f}_{_n} > 0)::INTEGER AS {_f}_optout{_n}")
cte("flags", "labelled", f"SELECT parentname, {', '.join(_outer)} FROM (SELECT parentname, {', '.join(_inner)} FROM labelled GROUP BY 1)")

# Calls and surveys --------------------------------------------------------------
CALLS = ["account_details_and_maintenance", "card_pin_maintenance", "express_check", "tech_support", "billing_and_payments", "fees",
         "online_system_inquiry", "transactions"]
_c = [f"{div0(f'sum({t}) FILTER ({R[n]})', f'count(*) FILTER ({R[n]} AND {t} <> 0)')} AS freq_{t}_{n}" for t in CALLS for n in (52, 8)]
_c += [f"{div0(f'sum(statuschangeflag_sum) FILTER ({R[n]})', f'sum(statuschangeflag_count) FILTER ({R[n]})')} AS status_change_lt3_ratio_{n}" for n in (52, 26, 8)]
cte("call_features", "labelled call_weekly", f"""
  SELECT *, {', '.join(f'status_change_lt3_ratio_52 - status_change_lt3_ratio_{n} AS "status_change_lt3_ch_1-52_1-{n}"' for n in (8, 26))}
  FROM (SELECT l.parentname, {', '.join(_c)} FROM labelled l LEFT JOIN call_weekly c ON c.parentname = l.parentname AND call_week = week GROUP BY 1)""")

COUNTS = ["productrating_cnt", "agentrating_cnt", "product_promoter_cnt", "product_detractor_cnt", "agent_promoter_cnt", "agent_detractor_cnt"]
# A rating average weighs a week by its rated responses, which makes it the mean of the ratings.
_s = [f"{div0(f'sum({w}_rating) FILTER ({w}_rating > 0 AND {R[n]})', f'count(*) FILTER ({w}_rating > 0 AND {R[n]})')} AS {w}_rating_avg_{n}" for w in ("product", "agent") for n in (52, 26, 8)]
_s += [f"{div0(f'sum({c}) FILTER ({R[n]})', f'sum(total_counts) FILTER ({R[n]})')} AS {c}_ratio_{n}" for c in COUNTS for n in (52, 26, 8)]
_s += [f"{div0(f'sum(issuesolved_solved_count) FILTER ({R[n]})', f'sum(issuesolved_all_count) FILTER ({R[n]})')} AS issue_solved_ratio_{n}" for n in (52, 26, 8)]
_d = [f'{c}_ratio_52 - {c}_ratio_{n} AS "{c}_ch_1-52_1-{n}"' for c in COUNTS + ["issue_solved"] for n in (26, 8)]
_d += [f'{w}_rating_avg_52 - {w}_rating_avg_{n} AS "{w}_rating_avg_ch_1-52_1-{n}"' for w in ("product", "agent") for n in (26, 8)]
cte("survey_features", "labelled survey_rows", f"""
  SELECT *, {', '.join(_d)} FROM (
    SELECT l.parentname, {', '.join(_s)} FROM labelled l LEFT JOIN survey_rows s ON s.parentname = l.parentname AND case_week = week GROUP BY 1)""")

cte("features", "static trx_features fee_features flags call_features survey_features run", """
  SELECT static.* REPLACE (CASE WHEN last_transaction_week > cutoff THEN 0 ELSE 1 END AS churn_flag), trx_features.* EXCLUDE (parentname),
         fee_features.* EXCLUDE (parentname), flags.* EXCLUDE (parentname), call_features.* EXCLUDE (parentname), survey_features.* EXCLUDE (parentname)
  FROM static JOIN trx_features USING (parentname) JOIN fee_features USING (parentname) JOIN flags USING (parentname)
  JOIN call_features USING (parentname) JOIN survey_features USING (parentname) CROSS JOIN run WHERE last_transaction_week > recent""")

PROB = "round(('0x' || substr(md5('0:' || parentname), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 4)"
cte("scored", "static labelled run", f"""
  SELECT parentname, customer_size, CASE WHEN last_transaction_week > cutoff THEN 0 ELSE 1 END AS churn_flag, {PROB} AS churn_prob,
         floor(round({PROB} * 10, 6))::INTEGER AS churn_rank, ({PROB} >= 0.5)::INTEGER AS churn_flag_predicted
  FROM static CROSS JOIN run WHERE last_transaction_week > recent""")

# Modelling ----------------------------------------------------------------------
_NOT = ["parentname", "last_transaction_week", "last_transaction_month", "customer_size", "customer_segment", "first_trx_month", "churn_flag", "credit_limit",
        "last_payment_method", "state_code", "num_of_trucks", "billing_freq", "credit_grade", "channel", "product_type_most_frequent"]
cte("model", "features", f"SELECT parentname, churn_flag AS y, COLUMNS(* EXCLUDE ({', '.join(_NOT)}))::DOUBLE FROM features")
cte("long", "model", "SELECT parentname, y, measure, value FROM (UNPIVOT model ON COLUMNS(* EXCLUDE (parentname, y)) INTO NAME measure VALUE value)")
cte("names", "long", "SELECT DISTINCT measure FROM long")
cte("anova", "long", """
  SELECT measure, round((sum(n * (m - g) ** 2) / (count(*) - 1)) / nullif(sum(n * v) / (sum(n) - count(*)), 0), 6) AS f
  FROM (SELECT measure, y, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM long GROUP BY 1, 2)
  JOIN (SELECT measure, avg(value) AS g FROM long GROUP BY 1) USING (measure) GROUP BY 1""")
cte("mi", "long", """
  SELECT measure, round(sum(n / t * ln(n * t / (ny * nb))), 6) AS mi FROM (
    SELECT measure, n, sum(n) OVER (PARTITION BY measure)::DOUBLE AS t, sum(n) OVER (PARTITION BY measure, y)::DOUBLE AS ny, sum(n) OVER (PARTITION BY measure, b)::DOUBLE AS nb
    FROM (SELECT measure, y, len(list_filter(list_distinct(e), lambda x: x < value)) AS b, count(*)::DOUBLE AS n
          FROM long JOIN (SELECT measure, quantile_cont(value, [0.25, 0.5, 0.75]) AS e FROM long GROUP BY 1) USING (measure) GROUP BY 1, 2, 3)) GROUP BY 1""")
