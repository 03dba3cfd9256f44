"""Logical inputs of the pipeline, projected from the benchmark tables.

Each function yields one logical input in the shape the operators expect. With
real feeds these projections are replaced by the feeds themselves.
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import weeks as wk
from ebbtide.operators.calendar import fiscal_calendar
from ebbtide.params import RunParams
from ebbtide.sources.tables import Tables, within_days

Days = tuple[dt.date, dt.date] | None

PRODUCT_OF_TYPE = {
    "SMALL": "FUEL", "MEDIUM": "MASTERCARD", "LARGE": "PROPRIETARY",
    "ECONOMY": "ECASH", "STANDARD": "EXPRESS CHECK", "PROMO": "NON-CORE",
}
STATE_CODES = ["ca", "TX", "FL", "OH", "IL", "GA", "MO", "NC", "TN", "PA", "AZ", "NV", "WA"]
CASE_TYPE_OF_EVENT = {
    "error": "Tech  Support", "click": "Online System Inquiry", "view": "Billing & Payments",
    "purchase": "Transaction", "signup": "Account  Maintenance",
}
ACCOUNT_WIDTH = 12


def _lookup(value: Column, mapping: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())]), value)


def _priority_digit() -> Column:
    return F.substring("o_orderpriority", 1, 1)


def _is_platform_a() -> Column:
    return F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def platform_days(t: Tables) -> DataFrame:
    """First and last transaction day of each platform."""
    return t.orders.groupBy(F.when(_is_platform_a(), "A").otherwise("B").alias("platform")).agg(
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
    )


def resolve_params(t: Tables, **changes) -> RunParams:
    """Read the two platform rows and fix the run week: the earlier of the last weeks."""
    rows = platform_days(t).collect()
    return RunParams(
        current_week=min(wk.week_key_of(wk.monday_of(r.last_day)) for r in rows),
        first_day=min(r.first_day for r in rows),
        last_day=max(r.last_day for r in rows),
        **changes,
    )


def accounts(t: Tables) -> DataFrame:
    """Account attributes: parent, line of business, size, state, score, limit, phone."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    parent = F.concat(F.lit("P"), F.lpad(F.floor(key / F.lit(10)).cast("string"), 10, "0"))
    index = F.pmod("c_nationkey", F.lit(len(STATE_CODES)))
    limit = F.floor(F.abs(balance)).cast("long")
    return t.customer.select(
        key.alias("customer_id"),
        F.when(F.pmod(key, F.lit(97)) != 96, parent).alias("parentname"),
        F.when(F.col("c_mktsegment") == "BUILDING", "OTHER").otherwise("NAT").alias("line_of_business"),
        F.when(balance < -900, None).when(balance < 3000, "B.1-11 trucks")
        .when(balance < 5000, "F.101-250 trucks").when(balance < 6000, "H.Over 500 trucks")
        .otherwise("A.express check account").alias("num_of_trucks"),
        F.when(F.col("c_nationkey") != 0, F.element_at(F.array(*map(F.lit, STATE_CODES)), (index + 1).cast("int"))).alias("state_code"),
        (F.lit(300) + F.floor(F.abs(balance) / 15)).cast("long").alias("credit_score"),
        F.when(F.pmod(key, F.lit(11)) == 0, None).when(F.pmod(key, F.lit(13)) == 0, 0).otherwise(limit).alias("credit_limit"),
        F.when(F.pmod(key, F.lit(5)) != 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone"),
    )


def first_months(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        wk.month_key(F.min("o_orderdate").cast("date")).alias("first_trx_month")
    )


def _orders(t: Tables, days: Days, customers: DataFrame | None) -> DataFrame:
    """Orders of the days; only those of ``customers`` (customer_id) where given, before anything is joined to them."""
    orders = t.orders.where(within_days("o_orderdate", days))
    return orders if customers is None else orders.join(customers, F.col("o_custkey") == F.col("customer_id"), "left_semi")


def _lines(t: Tables, days: Days, customers: DataFrame | None) -> DataFrame:
    return t.lineitem.join(_orders(t, days, customers), F.col("l_orderkey") == F.col("o_orderkey"))


def _sales(t: Tables, days: Days, customers: DataFrame | None = None) -> DataFrame:
    return _lines(t, days, customers).join(t.part, F.col("l_partkey") == F.col("p_partkey"))


IS_A = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
IS_FUEL = "p_type IN ('SMALL', 'MEDIUM', 'LARGE')"
NO_AMOUNTS = ["gas_gallons", "rebate_direct", "rebate_other", "rebate_variance", "discount_mainframe", "other_gallons",
              "trailer_cost", "other_cost", "product_amount_2", "product_amount_3", "oil_cost", "cash_advance_amount"]
NO_FLAGS = ["trailer_fuel", "other_fuel", "product_2", "product_3", "oil", "cash"]


BILLING_TYPE = "CASE WHEN pmod(l_suppkey, 10) = 3 THEN 'Express Check' ELSE 'MasterCard' END"
SERVICE_CENTRE = "CASE WHEN pmod(l_suppkey, 50) = 0 THEN 'MC901' ELSE 'SC001' END"


def activity(t: Tables, days: Days = None) -> DataFrame:
    """What of a transaction says that its account is active; needs no product."""
    return _lines(t, days, None).selectExpr(
        "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS trx_date", f"if({IS_A}, 'A', 'B') AS platform",
        f"CASE WHEN {IS_A} THEN {BILLING_TYPE} END AS billing_type", f"CASE WHEN NOT {IS_A} THEN {SERVICE_CENTRE} END AS service_centre",
    )


def _transaction_columns() -> list[str]:
    """Columns of both platforms; each fills its own."""
    platform_a = {
        "billing_type": BILLING_TYPE,
        "card_bin": "CASE pmod(l_suppkey, 10) WHEN 0 THEN '556736' WHEN 1 THEN '555622' WHEN 2 THEN '556766' ELSE '540000' END",
        "spend": "l_extendedprice",
        "txns": "1",
        "diesel_gallons": f"CASE WHEN {IS_FUEL} THEN l_quantity END",
        "rebate_mainframe": "l_extendedprice * l_discount",
    }
    platform_b = {
        "service_centre": SERVICE_CENTRE,
        "fuel_gallons": f"CASE WHEN {IS_FUEL} THEN l_quantity END",
        "tractor_cost": f"CASE WHEN {IS_FUEL} THEN l_extendedprice END",
        "product_amount_1": f"CASE WHEN NOT {IS_FUEL} THEN l_extendedprice END",
        "tractor_fuel": f"CASE WHEN {IS_FUEL} THEN 1 END",
        "product_1": f"CASE WHEN NOT {IS_FUEL} THEN 1 END",
        "select_discount": "l_extendedprice * l_discount",
        "fuel_rate": f"CASE WHEN {IS_FUEL} THEN l_tax END",
        "cash_advance_rate": "CASE WHEN l_linenumber = 1 THEN 0.5D END",
        "handling_charge": "CASE WHEN l_linestatus = 'O' THEN 0.25D END",
    }
    return [
        "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS trx_date", f"if({IS_A}, 'A', 'B') AS platform",
        *[f"CASE WHEN {IS_A} THEN {text} END AS {name}" for name, text in platform_a.items()],
        *[f"CASE WHEN NOT {IS_A} THEN {text} END AS {name}" for name, text in platform_b.items()],
        *[f"CAST(NULL AS DOUBLE) AS {name}" for name in NO_AMOUNTS],
        *[f"CAST(NULL AS INT) AS {name}" for name in NO_FLAGS],
    ]


def transactions(t: Tables, days: Days = None, customers: DataFrame | None = None) -> DataFrame:
    """Transactions of both platforms; each fills its own columns."""
    return _sales(t, days, customers).selectExpr(*_transaction_columns())


def ledger(t: Tables, days: Days = None, customers: DataFrame | None = None) -> DataFrame:
    """Fee ledger: signed amounts under product codes, late fees on their own account.

    A late fee counts on its load date and nothing else of its row does; the others count
    on their transaction date. So each kind is cut by its own date, in its own scan.
    """
    if days is None:
        return _ledger_rows(t.lineitem, _orders(t, None, customers), t.part)
    late = _ledger_rows(
        t.lineitem.where(within_days("l_shipdate", days) & (F.col("l_linenumber") == 1)), _orders(t, None, customers), t.part.where("p_size > 3")
    )
    other = _ledger_rows(t.lineitem, _orders(t, days, customers), t.part, "NOT (l_linenumber = 1 AND p_size > 3)")
    return late.unionByName(other)


def _ledger_rows(lines: DataFrame, orders: DataFrame, parts: DataFrame, condition: str = "true") -> DataFrame:
    source = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    late = "l_linenumber = 1 AND p_size > 3"
    signed = "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax ELSE -(l_extendedprice * l_tax) END"
    return source.join(parts, F.col("l_partkey") == F.col("p_partkey")).where(condition).selectExpr(
        f"concat('AR-', lpad(CAST(o_custkey AS STRING), {ACCOUNT_WIDTH}, '0')) AS account_no",
        "CAST(l_shipdate AS DATE) AS load_date",
        "CAST(o_orderdate AS DATE) AS tran_date",
        """CASE WHEN p_size <= 3 THEN '00700' WHEN l_linenumber = 5 THEN '00175'
                WHEN l_linenumber = 7 THEN if(l_linestatus = 'O', '00200', '00630')
                WHEN l_linenumber IN (2, 3, 4, 6) THEN '00500' ELSE '00999' END AS product_code""",
        "CASE WHEN p_size > 3 AND l_linenumber = 7 AND l_linestatus = 'O' THEN '90005' ELSE '90001' END AS sub_product_1",
        """CASE WHEN p_size <= 3 THEN lpad(CAST(p_size AS STRING), 5, '0') WHEN l_linenumber = 2 THEN '00068'
                WHEN l_linenumber = 3 THEN '00067' WHEN l_linenumber = 4 THEN '00074' WHEN l_linenumber = 6 THEN '00070'
                WHEN l_linenumber = 7 AND l_linestatus <> 'O' THEN '00004' ELSE '00000' END AS sub_product_2""",
        f"CASE WHEN {late} THEN if(pmod(l_orderkey, 2) = 0, 55, 54) END AS late_gl_no",
        f"CASE WHEN {late} THEN {signed} END AS late_gl_amount",
        f"{signed} AS revenue_amount",
    )


def products(t: Tables) -> DataFrame:
    """Product codes with descriptions."""
    size = F.col("p_size")
    return t.part.select(size).distinct().select(
        F.lit("00700").alias("product_code"), F.lit("90001").alias("sub_product_1"),
        F.lpad(size.cast("string"), 5, "0").alias("sub_product_2"),
        F.when(size <= 2, "ELD EQUIPMENT").when(size == 3, "ELD SUBSCR FEE").otherwise("OTHER").alias("description"),
    )


def settlements(t: Tables, days: Days = None, customers: DataFrame | None = None) -> DataFrame:
    amount = F.col("o_totalprice") * F.lit(0.001)
    return _orders(t, days, customers).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.when(F.pmod("o_orderkey", F.lit(10)) != 9, "X").otherwise("Z").alias("fee_type"),
        F.when(F.col("o_orderstatus") == "P", -amount).otherwise(amount).alias("fee_amount"),
    )


def _revenue_columns() -> list[Column]:
    return [
        wk.month_key(F.col("o_orderdate").cast("date")).alias("yearmonth"),
        _lookup(F.col("p_type"), PRODUCT_OF_TYPE).alias("producttype"),
        F.col("l_extendedprice").alias("netspend"),
    ]


def monthly_revenue(t: Tables, days: Days = None) -> DataFrame:
    return _sales(t, days).select(F.col("o_custkey").alias("customer_id"), *_revenue_columns())


def sales(t: Tables, days: Days = None) -> DataFrame:
    """Transactions, each with its monthly revenue, so that one join of the lines serves both."""
    return _sales(t, days).select(*map(F.expr, _transaction_columns()), *_revenue_columns())


def billing_terms(t: Tables) -> DataFrame:
    """Customer master changes: billing cycle and terms."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("modified"),
        F.col("o_orderkey").alias("entry"),
        F.col("l_linenumber").alias("line"),
        _lookup(F.col("o_orderstatus"), {"F": "daily", "O": "weekly", "P": "monthly"}).alias("billing_cycle"),
        F.col("l_quantity").cast("long").alias("terms"),
    )


def deals(t: Tables) -> DataFrame:
    """Sales bookings with the channel and the team that made them."""
    channel = {"1": "Inbound", "2": "Outbound", "3": "Field", "4": "Unk", "5": "Regional Sales"}
    team = {"1": "National", "2": "Strategic", "3": "Account Mgmt", "4": "Telesales", "5": "Other"}
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("booked"), F.col("o_orderkey").alias("entry"),
        _lookup(_priority_digit(), channel).alias("channel"), _lookup(_priority_digit(), team).alias("team"),
    )


def payments(t: Tables) -> DataFrame:
    letter = {"1": "A", "2": "D", "3": "Q", "4": "W", "5": "X"}
    number = F.concat(
        _lookup(_priority_digit(), letter),
        F.when(F.pmod("o_orderkey", F.lit(2)) == 0, "-ACH").otherwise("-CHK"),
    )
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("paid"), F.col("o_orderkey").alias("entry"),
        number.alias("remittance_no"),
    )


def contacts(t: Tables) -> DataFrame:
    """CRM contacts: several per account."""
    key = F.col("c_custkey")
    entries = F.when(F.pmod(key, F.lit(3)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.customer.select(
        F.concat(F.lit("A"), key.cast("string")).alias("account_ref"),
        key.alias("customer_id"),
        F.explode(entries).alias("contact_no"),
    )


def _event_key(t: Tables) -> tuple[Column, Column]:
    """Account reference and day an event is spread onto."""
    accounts_total = t.customer.agg(F.max("c_custkey") + 1).scalar()
    last = t.orders.agg(F.max("o_orderdate").cast("date")).scalar()
    back = F.pmod(F.floor(F.col("event_id") / F.lit(5)), F.lit(104)) * 7
    account = F.concat(F.lit("A"), F.pmod(F.col("event_id"), accounts_total).cast("string"))
    return account, F.date_sub(last, back.cast("int"))


def cases(t: Tables) -> DataFrame:
    account, created = _event_key(t)
    return t.events.select(
        account.alias("account_ref"), created.alias("created_date"),
        _lookup(F.col("event_type"), CASE_TYPE_OF_EVENT).alias("type"),
        F.when(F.floor(F.col("value")) % 17 == 0, "High  Risk").alias("subtype"),
        (F.floor(F.col("value")) % 6).cast("int").alias("status_changes"),
        F.lit(None).cast("string").alias("satisfied"),
        F.lit(None).cast("string").alias("resolution"),
        created.alias("last_modified"),
        created.alias("closed"),
    )


def surveys(t: Tables) -> DataFrame:
    account, created = _event_key(t)
    value = F.floor(F.col("value"))
    product = (value % 11).cast("int")
    agent = (F.floor(F.col("value") / 2) % 11).cast("int")

    def promoter(rating: Column) -> Column:
        return F.when(rating >= 9, "Promoter").when(rating <= 6, "Detractor").otherwise("Passive")

    return t.events.where(F.col("event_type").isin("purchase", "signup")).select(
        account.alias("account_ref"), created.alias("created_date"),
        F.when(F.col("event_id") % 4 != 0, created).alias("response_date"),
        F.when(value % 3 == 0, "Absolutely").otherwise("Not yet").alias("issue_solved"),
        product.alias("product_rating"), agent.alias("agent_rating"),
        promoter(product).alias("product_nps"), promoter(agent).alias("agent_nps"),
    )


def churn_probability(parent: Column) -> Column:
    """A fixed pseudo-score per parent, for queries that need scores without a model."""
    digits = F.substring(F.md5(F.concat(F.lit("0:"), parent).cast("binary")), 1, 8)
    return F.round(F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0), 4)


def calendar(t: Tables, p: RunParams) -> DataFrame:
    return fiscal_calendar(t.spark, p)
