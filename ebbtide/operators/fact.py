"""Weekly fact per account: transactions, channel spend and fees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.ratios import SUM_DECIMALS, zero_sum
from ebbtide.operators.calendar import week_grid, with_week
from ebbtide.params import RunParams

# Billing types, card bins and service centres.
CARD_BILLING = "MasterCard"
EXPRESS_BILLING = "Express Check"
ECASH_BIN = "556736"
VIRTUAL_CHECK_BIN = "555622"
VCAP_BIN = "556766"
EXCLUDED_CENTRES = ["MC901", "MC902", "MC903", "MC904", "MC905"]

# Ledger accounts and product codes behind each fee.
LATE_LEDGER_NUMBERS = ["00055", "00054"]
EQUIPMENT_DESCRIPTIONS = ["ELD EQUIPMENT", "ELD SUBSCR FEE"]
SETTLEMENT_FEE_TYPE = "X"

TRX_MEASURES = [
    "total_gallons", "total_fuel_trx", "total_nonfuel_trx", "total_num_trx",
    "total_fuel_spend", "total_nonfuel_spend", "total_spend", "total_discount",
]
CHANNEL_MEASURES = [
    "total_comcheck_spend", "total_vcomcheckspend", "total_vcap_spend", "total_ecashspend", "ecash_gallons",
]
# Fee name -> amount, refund, applied and refunded columns.
FEE_COLUMNS = {
    "late": ("late_interest_fee_amount", "late_interest_fee_refund", "num_of_late_fees_applied", "num_of_late_fees_refunded"),
    "risk": ("risk_based_pricing_amount", "risk_based_pricing_refund", "num_of_risk_fees_applied", "num_of_risk_fees_refunded"),
    "optional": ("optional_program_amount", "optional_program_refund", "num_of_optional_fees_applied", "num_of_optional_fees_refunded"),
    "proximity": ("proximity_fee_amount", "proximity_fee_refund", "num_of_prox_fees_applied", "num_of_prox_fees_refunded"),
    "fleet_advance": ("fleet_advance_fee_amount", "fleet_advance_refund", "num_of_fleet_adv_applied", "num_of_fleet_adv_refunded"),
    "card": ("card_fee_amount", "card_fee_refund", "num_of_card_fees_applied", "num_of_card_fees_refunded"),
    "inactivity": ("inactivity_fee_amount", "inactivity_fee_refund", "num_of_inac_fees_applied", "num_of_inac_fees_refunded"),
    "check_admin": ("check_admin_amount", "check_admin_refund", "num_of_admin_fees_applied", "num_of_admin_fees_refunded"),
    "equipment": ("eld_equi_fee_amount", "eld_equi_fee_refund", "num_of_eld_eqi_fees_applied", "num_of_eld_eqi_fees_refunded"),
    "express": ("express_fee_amount", "express_fee_refund", "num_of_expr_fees_applied", "num_of_expr_fees_refunded"),
}
LEDGER_FEES = [f for f in FEE_COLUMNS if f != "express"]
PLATFORM_FEE = ["fleet_transaction_fee", "num_of_fleet_fees_applied"]
PROGRAM_FEES = ["fleet_advance", "card"]
OTHER_FEES = ["inactivity", "check_admin", "express", "equipment"]
SINGLE_FEES = ["late", "risk", "optional", "proximity"]

RAW_MEASURES = TRX_MEASURES + CHANNEL_MEASURES + PLATFORM_FEE + [c for f in FEE_COLUMNS.values() for c in f]
COUNT_MEASURES = {c for c in RAW_MEASURES if c.startswith("num_of_")} | {"total_fuel_trx", "total_nonfuel_trx", "total_num_trx"}
INTERNAL_MEASURES = [FEE_COLUMNS[f][i] for f in ["card", "inactivity", "check_admin", "equipment", "express"] for i in (0, 1)]
INTERNAL_MEASURES.append("fleet_transaction_fee")
DERIVED_MEASURES = [
    "program_fee_amount", "program_fee_refund", "other_fees_amount", "other_fees_refund",
    "tot_fee_amount", "tot_fee_refund", "num_of_program_fees_applied", "num_of_program_fees_refunded",
    "num_of_other_fees_applied", "num_of_other_fees_refunded",
]
FACT_MEASURES = [m for m in RAW_MEASURES if m not in INTERNAL_MEASURES] + DERIVED_MEASURES


def total(measure: str) -> Column:
    """Weekly sum of a measure; null when no source row exists."""
    if measure in COUNT_MEASURES:
        return F.expr(f"CAST(sum({measure}) AS BIGINT) AS {measure}")
    return F.expr(f"round(sum({measure}), {SUM_DECIMALS}) AS {measure}")


def named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in expressions.items()]


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------- transactions

# Rows that make an account active: all of A, B outside excluded centres.
COUNTS_FOR_ACTIVITY = f"(platform = 'A' OR service_centre NOT IN ({quoted(EXCLUDED_CENTRES)}))"
CORE_A = (
    f"(platform = 'A' AND billing_type = '{CARD_BILLING}'"
    f" AND card_bin NOT IN ({quoted([ECASH_BIN, VIRTUAL_CHECK_BIN, VCAP_BIN])}))"
)
CORE_B = f"(platform = 'B' AND service_centre NOT IN ({quoted(EXCLUDED_CENTRES)}))"

# Platform A: a row with gallons is fuel as a whole, any other is non-fuel.
FUEL_A = "(diesel_gallons > 0 OR gas_gallons > 0)"
MEASURES_A = {
    "total_gallons": zero_sum("diesel_gallons", "gas_gallons"),
    "fuel_spend": f"CASE WHEN {FUEL_A} THEN spend END",
    "nonfuel_spend": f"CASE WHEN {FUEL_A} THEN NULL ELSE spend END",
    "total_spend": "spend",
    "fuel_trx": f"CASE WHEN {FUEL_A} THEN txns ELSE 0 END",
    "nonfuel_trx": f"CASE WHEN {FUEL_A} THEN 0 ELSE txns END",
    "total_discount": zero_sum(
        "rebate_mainframe", "rebate_direct", "rebate_other", "rebate_variance", "discount_mainframe"),
}

# Platform B: cost columns say how much, item flags say what a row counts as.
FUEL_COSTS_B = ["tractor_cost", "trailer_cost", "other_cost"]
OTHER_COSTS_B = ["product_amount_1", "product_amount_2", "product_amount_3", "oil_cost", "cash_advance_amount"]
FUEL_FLAGS_B = ["tractor_fuel", "trailer_fuel", "other_fuel"]
OTHER_FLAGS_B = ["product_1", "product_2", "product_3", "oil", "cash"]
MEASURES_B = {
    "total_gallons": zero_sum("other_gallons", "fuel_gallons"),
    "fuel_spend": zero_sum(*FUEL_COSTS_B),
    "nonfuel_spend": zero_sum(*OTHER_COSTS_B),
    "total_spend": zero_sum(*FUEL_COSTS_B, *OTHER_COSTS_B),
    "fuel_trx": f"CASE WHEN {zero_sum(*FUEL_FLAGS_B)} > 0 THEN 1 ELSE 0 END",
    "nonfuel_trx": f"CASE WHEN {zero_sum(*OTHER_FLAGS_B)} > 0 THEN 1 ELSE 0 END",
    "total_discount": "coalesce(select_discount, 0)",
}


def trx_platform_a(trx: DataFrame, lob: DataFrame, calendar: DataFrame) -> DataFrame:
    """Row-level measures of platform A card transactions outside the three bins."""
    rows = trx.where(CORE_A).selectExpr("customer_id", "trx_date", *named(MEASURES_A))
    return in_scope(with_week(rows, F.col("trx_date"), calendar), lob)


def trx_platform_b(trx: DataFrame, lob: DataFrame, calendar: DataFrame) -> DataFrame:
    """Row-level measures of platform B transactions outside the excluded centres."""
    rows = trx.where(CORE_B).selectExpr("customer_id", "trx_date", *named(MEASURES_B))
    return in_scope(with_week(rows, F.col("trx_date"), calendar), lob)


def in_scope(rows: DataFrame, lob: DataFrame, name: str = "NAT") -> DataFrame:
    """Rows of accounts in one line of business (one row per account there)."""
    return rows.join(lob.where(F.col("line_of_business") == name).select("customer_id"), "customer_id", "left_semi")


def _either(measure: str) -> str:
    """A measure by the rule of the row's platform: zero if empty, null for rows that do not count."""
    return (
        f"CASE WHEN {CORE_A} THEN coalesce({MEASURES_A[measure]}, 0)"
        f" WHEN {CORE_B} THEN coalesce({MEASURES_B[measure]}, 0) END"
    )


FUEL_ROW_MEASURES = {
    "total_gallons": _either("total_gallons"),
    "total_fuel_trx": _either("fuel_trx"),
    "total_nonfuel_trx": _either("nonfuel_trx"),
    "total_num_trx": f"{_either('fuel_trx')} + {_either('nonfuel_trx')}",
    "total_fuel_spend": _either("fuel_spend"),
    "total_nonfuel_spend": _either("nonfuel_spend"),
    "total_spend": _either("total_spend"),
    "total_discount": _either("total_discount"),
}


def _card_spend(card_bin: str, value: str = "coalesce(spend, 0)") -> str:
    return f"CASE WHEN platform = 'A' AND billing_type = '{CARD_BILLING}' AND card_bin = '{card_bin}' THEN {value} END"


# Spend by card bin, null for rows outside the bin.
CHANNEL_ROW_MEASURES = {
    "total_comcheck_spend": f"CASE WHEN platform = 'A' AND billing_type = '{EXPRESS_BILLING}' THEN coalesce(spend, 0) END",
    "total_vcomcheckspend": _card_spend(VIRTUAL_CHECK_BIN),
    "total_vcap_spend": _card_spend(VCAP_BIN),
    "total_ecashspend": _card_spend(ECASH_BIN),
    "ecash_gallons": _card_spend(ECASH_BIN, zero_sum("diesel_gallons", "gas_gallons")),
}

# Sum of the three per-transaction rates and whether any applied; no centre is excluded.
_RATES = zero_sum("fuel_rate", "cash_advance_rate", "handling_charge")
PLATFORM_FEE_ROW_MEASURES = {
    "fleet_transaction_fee": f"CASE WHEN platform = 'B' THEN {_RATES} END",
    "num_of_fleet_fees_applied": f"CASE WHEN platform = 'B' THEN CAST({_RATES} > 0 AS INT) END",
}


def _weekly(rows: DataFrame, day: str, calendar: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Sums per account and week; weeks without any source row are left out."""
    projected = rows.selectExpr("customer_id", day, *named(measures))
    summed = with_week(projected, F.col(day), calendar).groupBy("customer_id", "week").agg(*[total(m) for m in measures])
    return summed.where(f"coalesce({', '.join(measures)}) IS NOT NULL")


def fuel_stats(trx: DataFrame, lob: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekly fuel statistics of both platforms together."""
    return in_scope(_weekly(trx, "trx_date", calendar, FUEL_ROW_MEASURES), lob)


def channel_spend_weekly(trx: DataFrame, active: DataFrame, calendar: DataFrame) -> DataFrame:
    return _weekly(trx, "trx_date", calendar, CHANNEL_ROW_MEASURES).join(active, "customer_id", "left_semi")


def platform_fee_weekly(trx: DataFrame, active: DataFrame, calendar: DataFrame) -> DataFrame:
    return _weekly(trx, "trx_date", calendar, PLATFORM_FEE_ROW_MEASURES).join(active, "customer_id", "left_semi")


# ------------------------------------------------------------------- accounts

def active_accounts(trx: DataFrame, lob: DataFrame, calendar: DataFrame, p: RunParams) -> DataFrame:
    """Accounts of the line of business with a transaction in the activity window."""
    rows = with_week(trx.where(COUNTS_FOR_ACTIVITY), F.col("trx_date"), calendar)
    rows = rows.where(F.col("week").between(p.activity_floor, p.current_week))
    return in_scope(rows.select("customer_id").distinct(), lob).where(F.col("customer_id").isNotNull())


def weekly_spine(active: DataFrame, p: RunParams) -> DataFrame:
    """Every active account with every week of the history window."""
    return week_grid(active, "customer_id", p)


# ----------------------------------------------------------------------- fees

# Fee behind a ledger row's product codes, null for other rows.
FEE_CLASS = """
    CASE WHEN product_code = '00500' AND sub_product_1 = '90001' AND sub_product_2 = '00068' THEN 'risk'
         WHEN product_code = '00500' AND sub_product_1 = '90001' AND sub_product_2 = '00067' THEN 'optional'
         WHEN product_code = '00500' AND sub_product_1 = '90001' AND sub_product_2 = '00074' THEN 'proximity'
         WHEN product_code = '00500' AND sub_product_1 = '90001' AND sub_product_2 = '00070' THEN 'card'
         WHEN product_code = '00175' THEN 'fleet_advance'
         WHEN product_code = '00200' AND sub_product_1 = '90005' THEN 'inactivity'
         WHEN product_code = '00630' AND sub_product_1 = '90001' AND sub_product_2 = '00004' THEN 'check_admin'
    END"""


def equipment_products(products: DataFrame) -> DataFrame:
    return products.where(F.col("description").isin(EQUIPMENT_DESCRIPTIONS)).select(
        "product_code", "sub_product_1", "sub_product_2", "description"
    )


def classified_ledger(ledger: DataFrame, products: DataFrame, code_width: int = 5) -> DataFrame:
    """(customer_id, fee, fee_date, amount) from one pass over the ledger.

    A row can be a late fee, a coded fee and an equipment fee independently;
    only the matching entries are emitted.
    """
    matched = ledger.join(
        equipment_products(products), ["product_code", "sub_product_1", "sub_product_2"], "left"
    )
    late = f"lpad(CAST(late_gl_no AS STRING), 5, '0') IN ({quoted(LATE_LEDGER_NUMBERS)})"

    def entry(condition: str, fee: str, day: str, amount: str) -> str:
        return f"CASE WHEN {condition} THEN named_struct('fee', {fee}, 'fee_date', {day}, 'amount', {amount}) END"

    entries = [
        entry(late, "'late'", "load_date", "late_gl_amount"),
        entry(f"{FEE_CLASS} IS NOT NULL", FEE_CLASS, "tran_date", "revenue_amount"),
        entry("description IS NOT NULL", "'equipment'", "tran_date", "revenue_amount"),
    ]
    return matched.selectExpr(
        f"CAST(right(account_no, {code_width}) AS BIGINT) AS customer_id",
        f"inline(array_compact(array({', '.join(entries)})))",
    )


def fee_row_measures(fees: list[str], negative_is_fee: bool = True) -> dict[str, str]:
    """Amount, refund and counts per fee.

    In the ledger a negative amount is a fee and a positive one a refund; both
    change sign. In settlements a positive amount is a fee and none changes sign.
    """
    signed = "-amount" if negative_is_fee else "amount"
    measures = {}
    for fee in fees:
        charged, refunded, applied, returned = FEE_COLUMNS[fee]
        measures[charged] = f"CASE WHEN fee = '{fee}' THEN greatest({signed}, 0) END"
        measures[refunded] = f"CASE WHEN fee = '{fee}' THEN least({signed}, 0) END"
        measures[applied] = f"CASE WHEN fee = '{fee}' THEN CAST({signed} > 0 AS INT) END"
        measures[returned] = f"CASE WHEN fee = '{fee}' THEN CAST({signed} < 0 AS INT) END"
    return measures


def settlement_rows(settlements: DataFrame) -> DataFrame:
    return settlements.where(F.trim("fee_type") == SETTLEMENT_FEE_TYPE).select(
        "customer_id", F.lit("express").alias("fee"), F.col("invoice_date").alias("fee_date"), F.col("fee_amount").alias("amount")
    )


def fee_ledger_weekly(ledger: DataFrame, products: DataFrame, active: DataFrame, calendar: DataFrame, code_width: int = 5) -> DataFrame:
    """Nine ledger fees per account and week from one scan."""
    rows = classified_ledger(ledger, products, code_width)
    return _weekly(rows, "fee_date", calendar, fee_row_measures(LEDGER_FEES)).join(active, "customer_id", "left_semi")


def fee_equipment(ledger: DataFrame, products: DataFrame, active: DataFrame, calendar: DataFrame, code_width: int = 5) -> DataFrame:
    """Equipment fees only: ledger joined with products on three code columns."""
    rows = ledger.join(equipment_products(products), ["product_code", "sub_product_1", "sub_product_2"]).select(
        F.right("account_no", F.lit(code_width)).cast("long").alias("customer_id"),
        F.lit("equipment").alias("fee"), F.col("tran_date").alias("fee_date"), F.col("revenue_amount").alias("amount"),
    )
    return _weekly(rows, "fee_date", calendar, fee_row_measures(["equipment"])).join(active, "customer_id", "left_semi")


def settlement_fee_weekly(settlements: DataFrame, active: DataFrame, calendar: DataFrame) -> DataFrame:
    measures = fee_row_measures(["express"], negative_is_fee=False)
    return _weekly(settlement_rows(settlements), "fee_date", calendar, measures).join(active, "customer_id", "left_semi")


# ----------------------------------------------------------------------- fact

def source_rows(trx: DataFrame, ledger: DataFrame, products: DataFrame, settlements: DataFrame, calendar: DataFrame, code_width: int = 5) -> DataFrame:
    """All sources as (customer_id, week, measures), measures of other sources null."""
    trx_measures = {**FUEL_ROW_MEASURES, **CHANNEL_ROW_MEASURES, **PLATFORM_FEE_ROW_MEASURES}

    def rows(source: DataFrame, day: str, measures: dict[str, str]) -> DataFrame:
        projected = source.selectExpr("customer_id", f"{day} AS _day", *named(measures))
        return with_week(projected, F.col("_day"), calendar).drop("_day")

    ledger_rows = classified_ledger(ledger, products, code_width)
    parts = [
        rows(trx, "trx_date", trx_measures),
        rows(ledger_rows, "fee_date", fee_row_measures(LEDGER_FEES)),
        rows(settlement_rows(settlements), "fee_date", fee_row_measures(["express"], negative_is_fee=False)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def derived_measures() -> list[str]:
    """Program, other and total fees. The transaction fee knows no refund."""
    every = SINGLE_FEES + PROGRAM_FEES + OTHER_FEES

    def fee(names: list[str], index: int, *extra: str) -> str:
        return zero_sum(*[FEE_COLUMNS[n][index] for n in names], *extra)

    return named({
        "program_fee_amount": f"round({fee(PROGRAM_FEES, 0, 'fleet_transaction_fee')}, {SUM_DECIMALS})",
        "program_fee_refund": f"round({fee(PROGRAM_FEES, 1)}, {SUM_DECIMALS})",
        "other_fees_amount": f"round({fee(OTHER_FEES, 0)}, {SUM_DECIMALS})",
        "other_fees_refund": f"round({fee(OTHER_FEES, 1)}, {SUM_DECIMALS})",
        "tot_fee_amount": f"round({fee(every, 0, 'fleet_transaction_fee')}, {SUM_DECIMALS})",
        "tot_fee_refund": f"round({fee(every, 1)}, {SUM_DECIMALS})",
        "num_of_program_fees_applied": fee(PROGRAM_FEES, 2, "num_of_fleet_fees_applied"),
        "num_of_program_fees_refunded": fee(PROGRAM_FEES, 3),
        "num_of_other_fees_applied": fee(OTHER_FEES, 2),
        "num_of_other_fees_refunded": fee(OTHER_FEES, 3),
    })


def account_weeks(rows: DataFrame) -> DataFrame:
    """Raw measures of source rows summed per account and week."""
    return rows.groupBy("customer_id", "week").agg(*[total(m) for m in RAW_MEASURES])


def with_derived(summed: DataFrame, key: str) -> DataFrame:
    kept = [m for m in RAW_MEASURES if m not in INTERNAL_MEASURES]
    return summed.selectExpr(key, "week", *kept, *derived_measures())


def sum_weeks(rows: DataFrame, key: str) -> DataFrame:
    """All measures summed per (key, week) in one shuffle, with the derived ones."""
    return with_derived(rows.groupBy(key, "week").agg(*[total(m) for m in RAW_MEASURES]), key)


def on_spine(summed: DataFrame, spine: DataFrame, key: str, zeros: list[str]) -> DataFrame:
    """Every spine week with its sums; the measures in ``zeros`` default to zero.

    Only the narrow spine is shuffled for this join: the sums are already
    partitioned by (key, week).
    """
    values = [f"coalesce({m}, 0) AS {m}" if m in zeros else m for m in FACT_MEASURES]
    return spine.select(key, "week").join(summed, [key, "week"], "left").selectExpr(key, "week", *values)


def weekly_fact(weeks: DataFrame, active: DataFrame, p: RunParams) -> DataFrame:
    """Dense account-by-week fact from ``account_weeks``; measures without a source row stay null."""
    return on_spine(with_derived(weeks, "customer_id"), weekly_spine(active, p), "customer_id", DERIVED_MEASURES)
