"""Account and parent metrics that prioritisation starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.ratios import SUM_DECIMALS
from ebbtide.operators import fact
from ebbtide.operators.calendar import with_week
from ebbtide.params import RunParams

CASE_WEEKS = 13
RECENT_WEEKS = [4, 8, 13, 26]


def _yearly(monthly: DataFrame, key: str) -> DataFrame:
    """Year totals, monthly averages and maxima, and the maximum scaled to a year."""
    def column(measure: str) -> list:
        total, best = f"round(sum({measure}), {SUM_DECIMALS})", f"max({measure})"
        return [
            F.expr(f"{total} AS last_52_weeks_{measure}"),
            F.expr(f"{total} / 12 AS monthly_avg_{measure}_last_52_weeks"),
            F.expr(f"{best} AS max_{measure}_per_month"),
            F.expr(f"round({best} * 12, {SUM_DECIMALS}) AS last_52_weeks_{measure}_max"),
        ]
    return monthly.groupBy(key).agg(*column("gallons"), *column("revenue"))


def combined_metrics(
    trx: DataFrame, parents: DataFrame, accounts: DataFrame, cases: DataFrame, calendar: DataFrame, p: RunParams
) -> DataFrame:
    """One row per active account: parent metrics end in ``_x``, account metrics in ``_y``."""
    mondays = p.activity_mondays[-52:]
    recent = {n: f"_monday >= DATE'{mondays[-n]}'" for n in RECENT_WEEKS}
    gallons = f"if(platform = 'A', {fact.MEASURES_A['total_gallons']}, {fact.MEASURES_B['total_gallons']})"
    revenue = f"if(platform = 'A', coalesce(spend, 0), {fact.MEASURES_B['total_spend']})"
    rows = trx.where(fact.COUNTS_FOR_ACTIVITY).selectExpr(
        "customer_id", "trx_date", f"{gallons} AS gallons", f"{revenue} AS revenue"
    )
    weekly = with_week(rows, F.col("trx_date"), calendar.where(F.col("week_starts") >= F.lit(mondays[0])), "inner", {
        "week_no": "week", "year": "_y", "fm_month": "_m", "week_starts": "_starts"}).withColumnRenamed("_starts", "_monday")
    # Month by account is the finest grain needed; everything else adds up from it.
    monthly = weekly.groupBy("customer_id", F.expr("_y * 100 + _m").alias("month")).agg(
        F.expr(f"round(sum(gallons), {SUM_DECIMALS}) AS gallons"),
        F.expr(f"round(sum(revenue), {SUM_DECIMALS}) AS revenue"),
        *[F.expr(f"sum(gallons) FILTER (WHERE {where}) AS g{n}") for n, where in recent.items()],
        F.max("week").alias("week"),
    ).join(parents, "customer_id")
    by_account = _yearly(monthly, "customer_id").withColumnsRenamed({c: f"{c}_y" for c in _yearly_names()})
    activity = monthly.groupBy("customer_id").agg(
        F.max("week").alias("last_transaction_week"), F.max("month").cast("int").alias("last_transaction_month"),
        *[F.expr(f"coalesce(round(sum(g{n}), {SUM_DECIMALS}), 0D) AS last_{n}_weeks_gallons") for n in RECENT_WEEKS],
    )
    parent_monthly = monthly.groupBy("parentname", "month").agg(
        *[F.expr(f"round(sum({m}), {SUM_DECIMALS}) AS {m}") for m in ("gallons", "revenue")]
    )
    by_parent = _yearly(parent_monthly, "parentname").withColumnsRenamed({c: f"{c}_x" for c in _yearly_names()})
    since = p.mondays[-CASE_WEEKS]
    recent_cases = cases.where(F.col("created_date") >= F.lit(since)).groupBy("customer_id").agg(
        F.count("*").alias("count_sf_cases_last3m")
    )
    phones = accounts.select("customer_id", "phone")
    joined = by_account.join(activity, "customer_id").join(parents, "customer_id")
    joined = joined.join(recent_cases, "customer_id", "left").join(phones, "customer_id", "left")
    joined = joined.withColumn("count_sf_cases_last3m", F.coalesce("count_sf_cases_last3m", F.lit(0)))
    return joined.join(by_parent, "parentname").withColumnsRenamed({"parentname": "parentname_x", "customer_id": "acctcode"})


def _yearly_names() -> list[str]:
    return [
        name for m in ("gallons", "revenue") for name in
        (f"last_52_weeks_{m}", f"monthly_avg_{m}_last_52_weeks", f"max_{m}_per_month", f"last_52_weeks_{m}_max")
    ]
