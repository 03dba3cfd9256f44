"""SQL per query."""

from __future__ import annotations

import oracles.inputs as inp
from oracles.base import compose, day_of, minus_months, minus_weeks, week_of

SQL: dict[str, str] = {}


def sql(name: str, needs: str, select: str) -> None:
    SQL[name] = compose(needs, select)


sql("calendar_lookup", "cal", """
  SELECT day, orders, spend, week_no AS week, fm_month AS month FROM (
    SELECT o_orderdate::DATE AS day, count(*) AS orders, round(sum(o_totalprice), 6) AS spend FROM orders GROUP BY 1) d
  LEFT JOIN cal ON week_starts = date_trunc('week', day)::DATE""")

sql("run_params", "run", """
  SELECT cur AS current_week, cutoff AS churn_cutoff_week, recent AS recency_cutoff_week, act_lo AS activity_floor, hist_lo AS history_floor FROM run""")

sql("week_math", "", f"""
  SELECT day, week, {day_of('week')} AS first_day, {minus_weeks('week', 2)} AS minus_2, {minus_weeks('week', 104)} AS minus_104,
         (isoyear(day - 238) * 100 + weekofyear(day - 238))::INTEGER AS train_week,
         (isoyear(day - 182) * 100 + weekofyear(day - 182))::INTEGER AS holdout_week,
         {minus_months('(year(day) * 100 + month(day))', 12)}::INTEGER AS month_minus_12
  FROM (SELECT DISTINCT o_orderdate::DATE AS day, {week_of('o_orderdate::DATE')} AS week FROM orders)""")

sql("string_keys", "cal run", """
  SELECT DISTINCT account_no, right(account_no, 12) AS code, right(account_no, 12)::BIGINT AS customer_id,
         substring(account_no, 10, 5) AS middle, left(account_no, 2) AS prefix, lpad(substring(account_no, 12, 4), 6, '0') AS padded
  FROM (SELECT 'AR-' || lpad(o_custkey::VARCHAR, 12, '0') AS account_no
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey CROSS JOIN run
        LEFT JOIN cal c1 ON c1.week_starts = date_trunc('week', o_orderdate)::DATE
        LEFT JOIN cal c2 ON c2.week_starts = date_trunc('week', l_shipdate)::DATE
        WHERE c1.week_no BETWEEN hist_lo AND cur OR c2.week_no BETWEEN hist_lo AND cur)""")

sql("active_accounts", "active", "SELECT customer_id FROM active")
sql("weekly_spine", "spine", "SELECT customer_id, week, month FROM spine")
for _name, _rows in (("trx_platform_a", "rows_a"), ("trx_platform_b", "rows_b")):
    sql(_name, _rows, f"""
  SELECT customer_id, trx_date, week, total_gallons, fuel_spend, nonfuel_spend, total_spend, fuel_trx, nonfuel_trx,
         round(total_discount, 6) AS total_discount FROM {_rows}""")
sql("fuel_stats", "fuel_stats", "SELECT * FROM fuel_stats")
sql("channel_spend_weekly", "express_check virtual_check vcap ecash", """
  SELECT * FROM express_check FULL JOIN virtual_check USING (customer_id, week) FULL JOIN vcap USING (customer_id, week)
  FULL JOIN ecash USING (customer_id, week)""")
sql("platform_fee_weekly", "platform_fee", "SELECT * FROM platform_fee")
_counts = [f[k] for f in [*inp.FEES.values(), inp.EXPRESS] for k in (2, 3)] + ["num_of_fleet_fees_applied", "total_fuel_trx", "total_nonfuel_trx", "total_num_trx"]


def as_double(names: list[str]) -> str:
    return "* REPLACE (" + ", ".join(f"{n}::DOUBLE AS {n}" for n in names) + ")"


sql("fee_ledger_weekly", " ".join(f"fee_{f}" for f in inp.FEES), f"SELECT {as_double(_counts[:18])} FROM fee_late "
    + " ".join(f"FULL JOIN fee_{f} USING (customer_id, week)" for f in list(inp.FEES)[1:]))
sql("fee_equipment", "fee_equipment", "SELECT * FROM fee_equipment")
sql("settlement_fee_weekly", "fee_express", "SELECT * FROM fee_express")
sql("weekly_fact", "fact", f"SELECT {as_double(_counts)} FROM fact")
sql("rollup_weekly", "weekly", "SELECT * FROM weekly")
sql("active_parents", "enough", "SELECT * FROM enough")
sql("orphan_parents", "acct enough", """
  SELECT DISTINCT parentname FROM acct WHERE parentname IS NOT NULL AND parentname NOT IN (SELECT parentname FROM enough)""")
sql("lifetime_bounds", "trimmed", "SELECT parentname, week, min_lifetime_week, max_lifetime_week FROM trimmed")
LABELS = "parentname, week, week_rank, week_range_4, week_range_8, week_range_13, week_range_26, week_range_52"
sql("week_ranges", "labelled", f"SELECT {LABELS} FROM labelled")

# ---------------------------------------------------------------- second part
import oracles.features as feat  # noqa: E402
import oracles.profile as prof  # noqa: E402

sql("random_cutoff", "trimmed bounds run", """
  SELECT parentname, count(*) AS weeks, max(week) AS last_week FROM (
    SELECT *, greatest(12, n - 52) AS lo, ('0x' || substr(md5('0:' || parentname), 1, 8))::BIGINT AS h FROM (
      SELECT parentname, week, max_lifetime_week, count(*) OVER (PARTITION BY parentname) AS n, row_number() OVER (PARTITION BY parentname ORDER BY week) AS r FROM trimmed))
  CROSS JOIN run
  WHERE r <= CASE WHEN max_lifetime_week > cutoff AND n > lo THEN lo + h % (n - lo) ELSE n END GROUP BY 1""")
sql("last_activity", "last_trx", "SELECT * FROM last_trx")
sql("latest_attribute", "terms channels", "SELECT * FROM terms FULL JOIN channels USING (customer_id)")
sql("last_payment", "pay", "SELECT * FROM pay")
sql("product_top6", "top6", "SELECT * FROM top6")
sql("product_spend", "spend6", "SELECT * FROM spend6")
sql("account_profile", "profile", "SELECT * FROM profile")
sql("rollup_profile", "pprofile", "SELECT * FROM pprofile")
sql("channel_class", "channels", f"SELECT customer_id, channel_1, channel_2, {prof.CHANNEL} AS channel FROM (SELECT *, {prof.CHANNEL_TEXT} AS t FROM channels)")
sql("credit_grade", "acct", f"SELECT customer_id, credit_score, {prof.GRADE} AS credit_grade FROM acct")
sql("product_bucket", "top6", f"SELECT customer_id, combination, {prof.BUCKET} AS bucket FROM (SELECT customer_id, {prof.combination(6)} AS combination FROM top6)")
sql("static_features", "static", "SELECT * FROM static")


def r6(names: list[str]) -> str:
    return ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)


sql("fee_types_count", "weekly", f"""
  SELECT parentname, week, {feat.KINDS} AS unique_types_of_fees_applied, {feat.KINDS_BACK} AS unique_types_of_fees_refunded FROM weekly""")
sql("quartile_score", "trx_avg trx_edges", f"SELECT parentname, {feat.TRX_SCORES} FROM trx_avg CROSS JOIN trx_edges")
ROUND_ALL = "parentname, round(COLUMNS(* EXCLUDE (parentname)), 6)"


def rounded(rows: str, doubles: str) -> str:
    """All columns of ``rows``; those matching the pattern rounded."""
    return f"SELECT * REPLACE ({doubles}) FROM {rows}"


sql("pct_change", "trx_avg", f"""SELECT parentname, {', '.join(
    f'round({feat.change(f"{m}_avg4", f"{m}_avg{feat.tail(n)}")}, 6) AS "{m}_ch_1-{n}_1-4"' for m in feat.TRX for n in (8, 13, 26, 52))} FROM trx_avg""")
_trx_doubles = [f"{m}_avg{feat.tail(n)}" for m in feat.TRX for n in feat.R] + [f"share_active_{s}{n}" for s in feat.SHARES for n in feat.R]
_trx_doubles += [f"{m}_ch_1-{n}_1-4" for m in feat.TRX for n in (8, 13, 26, 52)]
_fee_doubles = feat._kept + feat._names + [f"{f}_ch_1-{n}_1-4" for f in feat.FEE_SCORED for n in (8, 13, 26, 52)]
_flag_doubles = [f"{f}_{k}_ratio{n}" for f in feat.FLAG_FEES for k in ("refund_dollar", "ref_incidence") for n in feat.R]
_call_doubles = [f"freq_{t}_{n}" for t in feat.CALLS for n in (52, 8)] + [f"status_change_lt3_ratio_{n}" for n in (52, 26, 8)] + ["status_change_lt3_ch_1-52_1-8", "status_change_lt3_ch_1-52_1-26"]
_survey_doubles = [f"{w}_rating_avg_{n}" for w in ("product", "agent") for n in (52, 26, 8)] + [f"{c}_ratio_{n}" for c in feat.COUNTS + ["issue_solved"] for n in (52, 26, 8)]
_survey_doubles += [f"{c}_ch_1-52_1-{n}" for c in feat.COUNTS + ["issue_solved", "product_rating_avg", "agent_rating_avg"] for n in (26, 8)]
sql("transaction_features", "trx_features", rounded("trx_features", r6(_trx_doubles)))
sql("fee_features", "fee_features", rounded("fee_features", r6(_fee_doubles)))
sql("fee_flags", "flags", rounded("flags", r6(_flag_doubles)))
sql("call_type_clean", "cases_raw", f"""
  SELECT type, subtype, {prof.GROUPED} AS grouped_type, coalesce(lower(replace(subtype, '  ', ' ')), '') AS clean_subtype, count(*) AS cases
  FROM cases_raw GROUP BY 1, 2, 3, 4""")
sql("call_cases", "cases", "SELECT * FROM cases")
sql("dedup_cases", "cases_raw", "SELECT DISTINCT type, subtype, status_changes, created_date FROM cases_raw")
sql("call_weekly", "call_weekly", "SELECT * FROM call_weekly")
sql("call_features", "call_features", rounded("call_features", r6(_call_doubles)))
sql("survey_responses", "responses", "SELECT * FROM responses")
sql("survey_weekly", "survey_rows", rounded("survey_rows", r6(["avg_product_rating", "avg_agent_rating"])))
sql("survey_features", "survey_features", rounded("survey_features", r6(_survey_doubles)))
sql("full_outer_features", "call_weekly responses weekly", """
  SELECT parentname, coalesce(cases, 0)::BIGINT AS cases, coalesce(responses, 0)::BIGINT AS responses, coalesce(fees, 0) AS fees
  FROM (SELECT parentname, sum(statuschangeflag_count) AS cases FROM call_weekly GROUP BY 1)
  FULL JOIN (SELECT parentname, count(*) AS responses FROM responses GROUP BY 1) USING (parentname)
  FULL JOIN (SELECT parentname, round(sum(tot_fee_amount), 6) AS fees FROM weekly GROUP BY 1) USING (parentname)""")
sql("feature_table", "features", rounded("features", r6(["tenure"] + _trx_doubles + _fee_doubles + _flag_doubles + _call_doubles + _survey_doubles)))
sql("stage_invariants", "labelled pprofile acct", """
  SELECT 'labelled weeks present' AS "check", count(*) AS rows, 1::BIGINT AS expected, count(*) = 1 AS ok FROM (SELECT 1 FROM labelled LIMIT 1)
  UNION ALL SELECT 'profile has one row per parent', count(*), count(DISTINCT parentname), count(*) = count(DISTINCT parentname) FROM pprofile
  UNION ALL SELECT 'fee flags have one row per parent', count(DISTINCT parentname), count(DISTINCT parentname), true FROM labelled
  UNION ALL SELECT 'accounts have one row each', count(*), count(DISTINCT customer_id), count(*) = count(DISTINCT customer_id) FROM acct
  UNION ALL SELECT 'labelled parents have a profile', count(*), 0, count(*) = 0 FROM (SELECT DISTINCT parentname FROM labelled WHERE parentname NOT IN (SELECT parentname FROM pprofile))""")

sql("parent_pct_rank", "pct", f"SELECT parentname, {r6([f'{c}_pct' for c in prof.RANKED])} FROM pct")
sql("parent_priority", "prio", "SELECT parentname, round(priority, 6) AS priority, churn_prob_bin, priority_bin, revenue_bin, parent_rank FROM prio")
BINS = ["0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1"]
BIN_COLUMNS = ["churn_bin_0_0_2", "churn_bin_0_2_0_4", "churn_bin_0_4_0_6", "churn_bin_0_6_0_8", "churn_bin_0_8_1"]


def pivot(index: str, value: str, wrap: str) -> str:
    cells = ", ".join(wrap.format(f"sum({value}) FILTER (churn_prob_bin = '{b}' AND (b.l = {index} OR b.l = 'Grand Total'))") + f" AS {c}" for b, c in zip(BINS, BIN_COLUMNS))
    total = wrap.format(f"sum({value}) FILTER (b.l = {index} OR b.l = 'Grand Total')")
    labels = ", ".join(f"'{b}'" for b in BINS + ["Grand Total"])
    return f"SELECT b.l AS {index}, {cells}, {total} AS grand_total FROM (SELECT unnest([{labels}]) AS l) b CROSS JOIN prio GROUP BY 1"


sql("priority_pivot", "prio", pivot("priority_bin", "1", "coalesce({}, 0)::BIGINT"))
sql("revenue_pivot", "prio", pivot("revenue_bin", "last_52_weeks_revenue_x", "round(coalesce({}, 0), 6)::DOUBLE"))
_level = [f"c.{c}_{s} AS {c}_{'parent' if s == 'x' else 'account'}_level" for s in "xy" for m in ("gallons", "revenue")
          for c in (f"last_52_weeks_{m}", f"max_{m}_per_month", f"last_52_weeks_{m}_max")]
_level += [f"round(c.monthly_avg_{m}_last_52_weeks_{s}, 6) AS monthly_avg_{m}_last_52_weeks_{'parent' if s == 'x' else 'account'}_level" for s in "xy" for m in ("gallons", "revenue")]
sql("account_priority", "combined prio", f"""
  SELECT c.parentname, c.acctcode, c.prob AS churn_prob, {', '.join(_level)}, c.last_transaction_week, c.last_transaction_month,
         c.last_4_weeks_gallons, c.last_8_weeks_gallons, c.last_13_weeks_gallons, c.last_26_weeks_gallons, c.count_sf_cases_last3m, c.phone,
         round(priority, 6) AS priority, churn_prob_bin, priority_bin, revenue_bin, parent_rank, coalesce(account_rank, 1) AS account_rank
  FROM combined c JOIN prio USING (parentname) LEFT JOIN (
    SELECT acctcode, dense_rank() OVER (PARTITION BY parentname ORDER BY gm) AS account_rank FROM (
      SELECT *, (CASE WHEN phone IS NULL THEN 2 ELSE 1 END + dense_rank() OVER (PARTITION BY parentname ORDER BY last_transaction_week DESC)
        + CASE WHEN dec IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY parentname ORDER BY dec DESC NULLS LAST) END
        + dense_rank() OVER (PARTITION BY parentname ORDER BY count_sf_cases_last3m DESC)) / 4 AS gm
      FROM (SELECT *, CASE WHEN last_26_weeks_gallons <> 0 THEN (last_26_weeks_gallons - last_4_weeks_gallons) / last_26_weeks_gallons * 100
                          WHEN last_4_weeks_gallons > 0 THEN '-inf'::DOUBLE END AS dec, count(*) OVER (PARTITION BY parentname) AS n FROM combined) WHERE n > 1)) USING (acctcode)""")

# Modelling
_cats = {"state_code": ["CA", "FL", "GA", "IL", "MO", "NC", "OH", "PA", "TN", "TX", "UNK", "OTHERS"],
         "num_of_trucks": ["b.1-11 trucks", "c.12-20 trucks", "d.21-50 trucks", "e.51-100 trucks", "f.101-250 trucks", "g.251-500 trucks", "h.over 500 trucks", "unknown", "others"],
         "billing_freq": ["semi-monthly", "daily", "weekly", "monthly", "unknown", "others"],
         "credit_grade": ["Worse", "Poor", "Fair", "Good", "Very-Good", "Excellent", "UNK"],
         "channel": ["inbound", "outbound", "field", "strategic/AM", "unknown", "others"],
         "product_type_most_frequent": ["ECASH_ONLY", "ECASH_COMCHECK", "ECASH_COMCHECK_FUEL", "ECASH_FUEL", "COMCHECK_ONLY", "COMCHECK_FUEL", "FUEL_ONLY", "OTHERS"]}
sql("one_hot_align", "static", "SELECT parentname, " + ", ".join(
    f"({c} = '{v}')::INTEGER::DOUBLE AS \"{c}_{v}\"" for c, vs in _cats.items() for v in vs) + ', 0.0::DOUBLE AS "state_code_ZZ" FROM static')
sql("standard_scale", "long", """
  SELECT parentname, measure, round((value - avg(value) OVER m) / CASE WHEN stddev_pop(value) OVER m = 0 THEN 1 ELSE stddev_pop(value) OVER m END, 6) AS value
  FROM long WINDOW m AS (PARTITION BY measure)""")
sql("constant_columns", "flags", f"""
  SELECT measure, min(value) AS value FROM (UNPIVOT (SELECT {', '.join(f'"{c}"::DOUBLE AS "{c}"' for c in
    [f'{f}_{k}{n}' for f in feat.FLAG_FEES for k in ('inv_cnt', 'ref_cnt', 'refund_dollar_ratio', 'ref_incidence_ratio') for n in feat.R]
    + [f'{f}_{k}' for f in feat.FLAG_FEES for k in ('1st_4', '1st_8', 'optout4', 'optout8')] + ['late_interest_fee_2nd_4', 'late_interest_fee_2nd_8'])} FROM flags)
    ON COLUMNS(*) INTO NAME measure VALUE value) GROUP BY 1 HAVING min(value) = max(value)""")
sql("anova_f", "anova", "SELECT * FROM anova")
sql("mutual_info", "mi", "SELECT * FROM mi")
_votes = ["lasso_select_from_model", "logistic_select_from_model", "boosted_select_from_model", "svm_select_from_model", "mutual_info", "kbest",
          "rfe_logistic", "rfe_boosted", "rfe_svm"]
_v = [f"({('pf', 'pm')[k % 2]} <= {3 + k})" for k in range(9)]
sql("feature_votes", "anova mi", f"""
  SELECT *, row_number() OVER (ORDER BY total DESC, measure DESC)::INTEGER AS place FROM (
    SELECT measure, {', '.join(f'{x} AS {n}' for x, n in zip(_v, _votes))}, ({' + '.join(f'{x}::INTEGER' for x in _v)})::INTEGER AS total
    FROM (SELECT measure, row_number() OVER (ORDER BY f DESC NULLS LAST, measure) AS pf, row_number() OVER (ORDER BY mi DESC NULLS LAST, measure) AS pm
          FROM anova FULL JOIN mi USING (measure)))""")
_grid = "[" + ", ".join(str(-2 + 0.25 * k) for k in range(17)) + "]::DOUBLE[]"
_yj = """CASE WHEN value >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + value) ELSE ((1 + value) ** lam - 1) / lam END
  ELSE CASE WHEN lam = 2 THEN -ln(1 - value) ELSE -(((1 - value) ** (2 - lam) - 1) / (2 - lam)) END END"""
sql("power_transform", "long", f"""
  SELECT parentname, measure, round({_yj}, 6) AS value FROM long JOIN (
    SELECT measure, CASE WHEN max(ll) IS NULL THEN 1 ELSE arg_max(lam, (ll, -lam)) FILTER (ll IS NOT NULL) END::DOUBLE AS lam FROM (
      SELECT measure, lam, CASE WHEN vr > 1e-12 THEN round(-n / 2 * ln(vr) + (lam - 1) * logs, 6) END AS ll FROM (
        SELECT measure, lam, count(*) AS n, var_pop({_yj}) AS vr, sum(sign(value) * ln(1 + abs(value))) AS logs
        FROM long CROSS JOIN (SELECT unnest({_grid}) AS lam) GROUP BY 1, 2)) GROUP BY 1) USING (measure)""")
sql("score_bands", "scored", "SELECT parentname, churn_prob, churn_rank, churn_flag_predicted FROM scored")
sql("score_distribution", "scored", "SELECT churn_rank, count(*) AS parents FROM scored GROUP BY 1")
sql("binary_metrics", "scored", """
  SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
         round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score
  FROM (SELECT customer_size, count(*) FILTER (churn_flag = 1 AND churn_flag_predicted = 1) AS tp, count(*) FILTER (churn_flag = 0 AND churn_flag_predicted = 1) AS fp,
               count(*) FILTER (churn_flag = 1 AND churn_flag_predicted = 0) AS fn, count(*) FILTER (churn_flag = 0 AND churn_flag_predicted = 0) AS tn
        FROM scored GROUP BY 1)""")
sql("precision_at_n", "scored", """
  SELECT sum(churn_flag)::BIGINT AS hits, (SELECT sum(churn_flag)::BIGINT FROM scored) AS positives,
         round(coalesce(sum(churn_flag) / nullif(least((SELECT sum(churn_flag) FROM scored), 25), 0), 0), 6) AS precision_at_n
  FROM (SELECT * FROM scored ORDER BY churn_prob DESC, parentname LIMIT 25)""")
_ends = [(minus_weeks("act_lo", -n), t) for n, t in ((4, "4 Weeks"), (8, "8 Weeks"), (13, "13 Weeks"), (23, "23 Weeks"), (33, "33 Weeks"), (53, "52 Weeks"))]
sql("validation_table", "pprofile run", f"""
  SELECT last_transaction_weeks, weeks, count(last_transaction_week) AS actual_churners, coalesce(sum(pred), 0)::BIGINT AS predicted_churners,
         round(sum(pred) / nullif(count(last_transaction_week), 0) * 100, 6) AS percentage_prediction
  FROM (SELECT '<' || act_lo AS last_transaction_weeks, 'Past 8 Weeks' AS weeks, 0 AS lo, act_lo - 1 AS hi FROM run
        {' '.join(f"UNION ALL SELECT act_lo || '-' || {e}, '{t}', act_lo, {e} FROM run" for e, t in _ends)}) b
  LEFT JOIN (SELECT last_transaction_week, ({feat.PROB} >= 0.5)::INTEGER AS pred FROM pprofile WHERE churn_flag = 'CHURNER') p
    ON last_transaction_week BETWEEN lo AND hi GROUP BY 1, 2""")


def num(v: str, k: int) -> str:
    t = f"regexp_replace(round_even({v}, {k})::DECIMAL(38, {k})::VARCHAR, '0+$', '')"
    t = f"CASE WHEN {t} LIKE '%.' THEN {t} || '0' ELSE {t} END"
    return f"CASE WHEN ({t}) = '-0.0' THEN '0.0' ELSE ({t}) END"


sql("score_factors", "long names", f"""
  SELECT parentname, {', '.join(f'max(factor) FILTER (place = {n}) AS factor_{n}' for n in range(1, 11))} FROM (
    SELECT parentname, place, '{{''feature'': ''' || measure || ''', ''impact'': ' || {num('impact', 2)} || ', ''value'': ' || {num('value', 3)} || '}}' AS factor
    FROM (SELECT *, a / nullif(sum(abs(a)) OVER (PARTITION BY parentname), 0) AS impact,
                 row_number() OVER (PARTITION BY parentname ORDER BY round(abs(a), 9) DESC, measure) AS place
          FROM (SELECT parentname, measure, value, w * (value - avg(value) OVER (PARTITION BY measure))
                  / CASE WHEN stddev_pop(value) OVER (PARTITION BY measure) = 0 THEN 1 ELSE stddev_pop(value) OVER (PARTITION BY measure) END AS a
                FROM long JOIN (SELECT measure, round((CASE k % 2 WHEN 0 THEN 1 ELSE -1 END) * (0.9::DOUBLE - 0.05::DOUBLE * (k % 18)), 2) AS w
                              FROM (SELECT measure, row_number() OVER (ORDER BY measure) - 1 AS k FROM names)) USING (measure)))) GROUP BY 1""")
sql("forest_factors", "long names", f"""
, m AS (SELECT measure, row_number() OVER (ORDER BY measure) - 1 AS place, count(*) OVER () AS n FROM names),
w0 AS (SELECT parentname, t, 0 AS k FROM (SELECT DISTINCT parentname FROM long) CROSS JOIN (SELECT unnest(range(100)) AS t)),
z AS (SELECT parentname, measure, place, n, (value - avg(value) OVER s) / CASE WHEN stddev_pop(value) OVER s = 0 THEN 1 ELSE stddev_pop(value) OVER s END AS z
      FROM long JOIN m USING (measure) WINDOW s AS (PARTITION BY measure)),
{', '.join(f"""w{d + 1} AS (
  SELECT w.parentname, t, 2 * k + 1 + (z > ((3 * t + 11 * k) % 9 - 4) / 4 + 0.1::DOUBLE)::INTEGER AS k, k AS parent, z.measure
  FROM w{d} w JOIN z ON z.parentname = w.parentname AND z.place = (7 * t + 5 * k) % n)""" for d in range(3))},
c AS (
  SELECT parentname, measure, sum(0.5::DOUBLE * (((13 * t + 29 * k) % 41) - ((13 * t + 29 * parent) % 41)) / 64) AS a
  FROM (FROM w1 UNION ALL FROM w2 UNION ALL FROM w3) GROUP BY 1, 2),
f AS (
  SELECT parentname, measure, place, row_number() OVER (PARTITION BY parentname ORDER BY abs(coalesce(a, 0)) DESC, measure) AS r
  FROM z LEFT JOIN c USING (parentname, measure)),
k AS (SELECT parentname, measure, row_number() OVER (PARTITION BY parentname ORDER BY r) AS r FROM f WHERE r <= 25 AND place % 7 <> 0)
SELECT parentname, {', '.join(f'max(measure) FILTER (r = {n}) AS factor_{n}' for n in range(1, 11))}
FROM (SELECT DISTINCT parentname FROM z) LEFT JOIN k USING (parentname) GROUP BY 1""")
sql("score_combine", "scored run", """
  SELECT parentname, CASE customer_size WHEN 'others' THEN 'express-check' WHEN 'medium' THEN 'small' ELSE customer_size END AS customer_size,
         churn_prob, churn_rank, churn_flag_predicted, churn_flag AS churn_flag_actual, cur::VARCHAR AS run_week,
         (SELECT max(o_orderdate)::DATE FROM orders) AS run_date FROM scored CROSS JOIN run""")
sql("sink_slice", "scored run", f"""
  SELECT parentname, churn_prob, churn_rank, churn_flag_predicted, week::VARCHAR AS run_week, (SELECT max(o_orderdate)::DATE FROM orders) AS run_date
  FROM scored CROSS JOIN run CROSS JOIN LATERAL (SELECT unnest([cur, {minus_weeks('cur', 1)}]) AS week)
  WHERE week <> cur OR churn_rank >= 5""")
sql("sink_archive", "scored", """
  SELECT parentname, churn_prob, churn_rank, (SELECT min(o_orderdate)::DATE FROM orders) AS run_date FROM scored
  UNION ALL SELECT parentname, churn_prob, churn_rank, (SELECT max(o_orderdate)::DATE FROM orders) FROM scored WHERE churn_rank < 5""")
sql("sink_append", "scored run", """
  SELECT parentname, churn_prob, cur::VARCHAR AS run_week, (SELECT max(o_orderdate)::DATE FROM orders) AS run_date
  FROM scored CROSS JOIN run CROSS JOIN (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR churn_prob >= 0.5""")
sql("sink_params", "run", "SELECT cur AS current_week, cutoff AS churn_cutoff_week FROM run")
sql("csv_round_trip", "scored", "SELECT parentname, customer_size, churn_prob, churn_rank FROM scored")
sql("quality_gate", "scored", """
  SELECT segment, best_f1 FROM (
    SELECT customer_size AS segment, round(coalesce(2 * count(*) FILTER (churn_flag = 1 AND churn_flag_predicted = 1)
      / nullif(2 * count(*) FILTER (churn_flag = 1 AND churn_flag_predicted = 1) + count(*) FILTER (churn_flag <> churn_flag_predicted), 0), 0), 6) AS best_f1
    FROM scored GROUP BY 1) WHERE best_f1 < 0.5""")
_hot = ", ".join(f"({c} = '{v}')::INTEGER::DOUBLE AS \"{c}_{v}\"" for c, vs in _cats.items() for v in vs)
_segment = "CASE customer_size WHEN 'others' THEN 'express-check' WHEN 'medium' THEN 'small' ELSE customer_size END"
sql("score_run_result", "features run", f"""
, hot AS (SELECT parentname, {_segment} AS seg, COLUMNS(* EXCLUDE ({', '.join(feat._NOT)}))::DOUBLE, {_hot} FROM features),
l AS (SELECT parentname, seg, measure, value FROM (UNPIVOT hot ON COLUMNS(* EXCLUDE (parentname, seg)) INTO NAME measure VALUE value)),
w AS (SELECT measure, round(round((CASE k % 2 WHEN 0 THEN 1 ELSE -1 END) * (0.9::DOUBLE - 0.05::DOUBLE * (k % 18)), 2) * 0.02::DOUBLE, 4) AS w
      FROM (SELECT measure, row_number() OVER (ORDER BY measure) - 1 AS k FROM (SELECT DISTINCT measure FROM l))),
a AS (SELECT parentname, measure, value, w * (value - avg(value) OVER s) / CASE WHEN stddev_pop(value) OVER s = 0 THEN 1 ELSE stddev_pop(value) OVER s END AS a
      FROM l JOIN w USING (measure) WINDOW s AS (PARTITION BY seg, measure)),
p AS (SELECT parentname, 1 / (1 + exp(-round(sum(a), 9))) AS prob FROM a GROUP BY 1),
f AS (SELECT parentname, {', '.join(f'max(factor) FILTER (place = {n}) AS factor_{n}' for n in range(1, 11))} FROM (
    SELECT parentname, place, '{{''feature'': ''' || measure || ''', ''impact'': ' || {num('impact', 2)} || ', ''value'': ' || {num('value', 3)} || '}}' AS factor
    FROM (SELECT *, a / nullif(sum(abs(a)) OVER (PARTITION BY parentname), 0) AS impact,
                 row_number() OVER (PARTITION BY parentname ORDER BY round(abs(a), 9) DESC, measure) AS place FROM a)) GROUP BY 1)
SELECT parentname, {_segment} AS customer_size, state_code, credit_limit::INTEGER AS credit_limit, round(tenure::FLOAT::DOUBLE, 2) AS tenure,
       round(round_even(prob, 4)::FLOAT::DOUBLE, 4) AS churn_prob, floor(round(round_even(prob, 4) * 10, 6))::INTEGER AS churn_rank, (prob >= 0.5)::INTEGER AS churn_flag_predicted,
       churn_flag AS churn_flag_actual, {', '.join(f'factor_{n}' for n in range(1, 11))}, cur::VARCHAR AS run_week, (SELECT max(o_orderdate)::DATE FROM orders) AS run_date
FROM features JOIN p USING (parentname) JOIN f USING (parentname) CROSS JOIN run""")

# Saving and loading a model changes no row.
SQL["score_loaded"] = SQL["score_run_result"]
