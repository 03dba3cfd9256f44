"""Transaction, fee and fee-flag features per parent.

Each family is one aggregation over labelled weeks, partitioned by parent as
the labels already are, followed by expressions on one row per parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.order_stats import quartile_scores
from ebbtide.functions.ratios import SUM_DECIMALS, rate_change, ratio_or_sign, ratio_or_zero, relative_change

SHORT = [4, 8, 13, 26]
LENGTHS = [4, 8, 13, 26, 52]
CHANGES = {8: "1-8", 13: "1-13", 26: "1-26", 52: "1-52"}

# Measures per family.
TRANSACTION_MEASURES = [
    "total_gallons", "total_fuel_trx", "total_nonfuel_trx", "total_fuel_spend", "total_nonfuel_spend",
    "total_num_trx", "total_comcheck_spend", "total_vcap_spend", "total_ecashspend", "ecash_gallons",
]
SHARE_MEASURES = {
    "fuel": "total_gallons", "nonfuel": "total_nonfuel_spend", "trx": "total_num_trx",
    "comcheck_spend": "total_comcheck_spend", "vcap_spend": "total_vcap_spend", "ecash_spend": "total_ecashspend",
}
RATE_FEES = [
    "late_interest_fee_amount", "risk_based_pricing_amount", "program_fee_amount",
    "optional_program_amount", "other_fees_amount", "total_discount",
]
SHARE_FEES = [
    "risk_based_pricing_amount", "late_interest_fee_amount", "program_fee_amount",
    "optional_program_amount", "other_fees_amount",
]
COMPARED_SHARE_FEES = SHARE_FEES[:3]
FLAG_FEES = ["late_interest_fee", "program_fee", "optional_program", "risk_based_pricing", "other_fees"]
APPLIED_COUNTS = [
    "num_of_late_fees_applied", "num_of_risk_fees_applied", "num_of_optional_fees_applied", "num_of_fleet_adv_applied",
    "num_of_fleet_fees_applied", "num_of_inac_fees_applied", "num_of_admin_fees_applied", "num_of_expr_fees_applied",
    "num_of_eld_eqi_fees_applied", "num_of_card_fees_applied",
]
REFUNDED_COUNTS = [
    "num_of_late_fees_refunded", "num_of_risk_fees_refunded", "num_of_optional_fees_refunded", "num_of_fleet_adv_refunded",
    "num_of_inac_fees_refunded", "num_of_admin_fees_refunded", "num_of_expr_fees_refunded",
    "num_of_eld_eqi_fees_refunded", "num_of_card_fees_refunded",
]


def suffix(length: int) -> str:
    """The 52-week variant of an average carries no number."""
    return "" if length == 52 else str(length)


def in_range(length: int, label: str = "range-1") -> str:
    return f"week_range_{length} = '{label}'"


def total_where(value: str, condition: str) -> str:
    return f"round(sum({value}) FILTER (WHERE {condition}), {SUM_DECIMALS})"


def count_where(condition: str) -> str:
    return f"count_if({condition})"


def aggregate(labelled: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return labelled.groupBy("parentname").agg(*[F.expr(f"{text} AS `{name}`") for name, text in expressions.items()])


def extend(rows: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return rows.selectExpr("*", *[f"{text} AS `{name}`" for name, text in expressions.items()])


# ---------------------------------------------------------------- transactions

def transaction_averages(labelled: DataFrame) -> DataFrame:
    """Average per active week and share of active weeks, each per trailing range."""
    sums = {
        f"{kind}_{m}_{n}": text
        for m in TRANSACTION_MEASURES
        for n in LENGTHS
        for kind, text in (
            ("s", total_where(m, in_range(n))),
            ("n", count_where(f"{in_range(n)} AND {m} <> 0")),
        )
    }
    weeks = {f"w_{n}": count_where(in_range(n)) for n in SHORT} | {"w_52": "count(*)"}
    # Whole-year shares count all kept weeks, and fuel weeks need positive gallons.
    shares = {
        f"a_{name}_{n}": count_where(f"{in_range(n)} AND {m} <> 0") for name, m in SHARE_MEASURES.items() for n in SHORT
    } | {f"a_{name}_52": count_where(f"{m} > 0" if name == "fuel" else f"{m} <> 0") for name, m in SHARE_MEASURES.items()}
    summed = aggregate(labelled, {**sums, **weeks, **shares})
    averages = {
        f"{m}_avg{suffix(n)}": ratio_or_zero(f"s_{m}_{n}", f"n_{m}_{n}") for m in TRANSACTION_MEASURES for n in LENGTHS
    }
    share = {f"share_active_{name}{n}": ratio_or_zero(f"a_{name}_{n}", f"w_{n}") for name in SHARE_MEASURES for n in LENGTHS}
    return summed.selectExpr("parentname", *[f"{v} AS `{k}`" for k, v in {**averages, **share}.items()])


def pct_change(rows: DataFrame, measures: list[str]) -> DataFrame:
    """Change of the 4-week average against the 8, 13, 26 and 52-week ones."""
    return extend(rows, {
        f"{m}_ch_{CHANGES[n]}_1-4": relative_change(f"{m}_avg4", f"{m}_avg{suffix(n)}") for m in measures for n in CHANGES
    })


def transaction_features(labelled: DataFrame) -> DataFrame:
    """130 columns per parent. ``labelled`` is read several times and should be staged."""
    averages = transaction_averages(labelled)
    scored = quartile_scores(averages, "parentname", [f"{m}_avg" for m in TRANSACTION_MEASURES])
    return pct_change(scored, TRANSACTION_MEASURES)


# ------------------------------------------------------------------------ fees

def positive_kinds(counts: list[str]) -> str:
    """How many of the counts are positive."""
    return "(" + " + ".join(f"CAST(coalesce({c}, 0) > 0 AS INT)" for c in counts) + ")"


def fee_types_count(weekly: DataFrame) -> DataFrame:
    """Number of fee types applied and refunded in a week."""
    return extend(weekly, {
        "unique_types_of_fees_applied": positive_kinds(APPLIED_COUNTS),
        "unique_types_of_fees_refunded": positive_kinds(REFUNDED_COUNTS),
    })


def _overall(kind: str) -> str:
    """Fees per gallon over a set of weeks: null without either, zero if only gallons miss."""
    return f"CASE WHEN g_{kind} <> 0 THEN f_{kind} / nullif(g_{kind}, 0) WHEN f_{kind} <> 0 THEN 0D END"


def fee_rates(labelled: DataFrame) -> DataFrame:
    """Sums behind the fee features and everything that needs no other parent."""
    typed = fee_types_count(labelled)
    kinds = "unique_types_of_fees_applied"
    sums = {f"g_{n}": total_where("total_gallons", in_range(n)) for n in LENGTHS}
    sums |= {f"s_{f}_{n}": total_where(f, in_range(n)) for f in RATE_FEES for n in LENGTHS}
    sums |= {f"w_{n}": count_where(in_range(n)) for n in LENGTHS}
    sums |= {f"n_{f}_{n}": count_where(f"{in_range(n)} AND {f} <> 0") for f in SHARE_FEES for n in LENGTHS}
    sums |= {f"us_{n}": f"sum({kinds}) FILTER (WHERE {in_range(n)} AND {kinds} > 0)" for n in LENGTHS}
    sums |= {f"un_{n}": count_where(f"{in_range(n)} AND {kinds} > 0") for n in LENGTHS}
    for n in (4, 8):
        # Everything else counts as before, weeks without a label included.
        for name, where in ((f"now{n}", in_range(n)), (f"before{n}", f"NOT (week_range_{n} <=> 'range-1')")):
            sums[f"f_{name}"] = total_where("tot_fee_amount", where)
            sums[f"g_{name}"] = total_where("total_gallons", where)
    summed = aggregate(typed, sums)

    averages = {f"{f}_cents_p_gallon_avg": ratio_or_zero(f"s_{f}_52", "g_52") for f in RATE_FEES}
    averages |= {f"unique_num_of_fees_avg{suffix(n)}": ratio_or_zero(f"us_{n}", f"un_{n}") for n in LENGTHS}
    averages |= {f"{f}_share_avg{suffix(n)}": ratio_or_zero(f"n_{f}_{n}", f"w_{n}") for f in SHARE_FEES for n in LENGTHS}
    overall = {
        f"cents_p_gallon{n}": _overall(f"now{n}") for n in (4, 8)
    } | {f"cents_p_gallon_before{n}": _overall(f"before{n}") for n in (4, 8)}
    return extend(summed, {**averages, **overall})


def fee_features(labelled: DataFrame) -> DataFrame:
    """86 columns per parent. ``labelled`` is read several times and should be staged."""
    scored_names = [f"{f}_cents_p_gallon" for f in RATE_FEES] + ["unique_num_of_fees"] + [f"{f}_share" for f in COMPARED_SHARE_FEES]
    rates = quartile_scores(fee_rates(labelled), "parentname", [f"{f}_avg" for f in scored_names])
    changes = {
        f"{f}_cents_p_gallon_ch_{CHANGES[n]}_1-4": rate_change(f"s_{f}_4", "g_4", f"s_{f}_{n}", f"g_{n}")
        for f in RATE_FEES for n in CHANGES
    }
    changes |= {
        f"{f}_ch_{CHANGES[n]}_1-4": relative_change(f"{f}_avg4", f"{f}_avg{suffix(n)}")
        for f in ["unique_num_of_fees"] + [f"{f}_share" for f in COMPARED_SHARE_FEES] for n in CHANGES
    }
    flags = {f"max_cents_p_gallon{n}": f"CAST(coalesce(cents_p_gallon{n} > cents_p_gallon_before{n}, false) AS INT)" for n in (4, 8)}
    overall = [f"cents_p_gallon{n}" for n in (4, 8)] + [f"cents_p_gallon_before{n}" for n in (4, 8)]
    kept = [f"{f}_avg" for f in scored_names] + [f"{f}_share_avg{n}" for f in SHARE_FEES for n in SHORT]
    return rates.selectExpr(
        "parentname", *kept, *[f"coalesce({c}, 0D) AS {c}" for c in overall],
        *[f"{f}_score" for f in scored_names],
        *[f"{text} AS `{name}`" for name, text in {**flags, **changes}.items()],
    )


def fee_flags(labelled: DataFrame) -> DataFrame:
    """122 columns per parent: invoice and refund counts, ratios, first fees and opt-outs."""
    # Ranks are read off the labels, so an offset needs no care here.
    ranks = {
        4: in_range(4), 8: "week_range_4 IN ('range-1', 'range-2')", 13: in_range(13), 26: in_range(26),
        52: "week_range_26 IN ('range-1', 'range-2')",
    }
    before = {4: "NOT (week_range_4 <=> 'range-1')", 8: "week_range_4 IS NULL"}
    sums = {}
    for f in FLAG_FEES:
        charged, returned = f"{f}_amount <> 0", f"{f}_refund <> 0"
        for n in LENGTHS:
            sums[f"{f}_inv_cnt{n}"] = count_where(f"{ranks[n]} AND {charged}")
            sums[f"{f}_ref_cnt{n}"] = count_where(f"{ranks[n]} AND {returned}")
            sums[f"a_{f}_{n}"] = total_where(f"{f}_amount", in_range(n))
            sums[f"r_{f}_{n}"] = total_where(f"{f}_refund", in_range(n))
        for n in (4, 8):
            sums[f"b_{f}_{n}"] = count_where(f"{before[n]} AND {charged}")
            sums[f"p_{f}_{n}"] = count_where(f"{in_range(n, 'range-2')} AND {charged}")
    summed = aggregate(labelled, sums)

    columns = {}
    for f in FLAG_FEES:
        for n in LENGTHS:
            columns[f"{f}_inv_cnt{n}"] = f"{f}_inv_cnt{n}"
            columns[f"{f}_ref_cnt{n}"] = f"{f}_ref_cnt{n}"
            columns[f"{f}_refund_dollar_ratio{n}"] = ratio_or_sign(f"(-r_{f}_{n})", f"a_{f}_{n}")
            columns[f"{f}_ref_incidence_ratio{n}"] = ratio_or_zero(f"{f}_ref_cnt{n}", f"{f}_inv_cnt{n}")
        for n in (4, 8):
            first = f"b_{f}_{n} = 0"
            columns[f"{f}_1st_{n}"] = f"CAST({f}_inv_cnt{n} >= 1 AND {first} AS INT)"
            if f == "late_interest_fee":
                columns[f"{f}_2nd_{n}"] = f"CAST({f}_inv_cnt{n} >= 2 AND {first} AS INT)"
            columns[f"{f}_optout{n}"] = f"CAST({f}_inv_cnt{n} = 0 AND p_{f}_{n} > 0 AS INT)"
    return summed.selectExpr("parentname", *[f"{text} AS {name}" for name, text in columns.items()])
