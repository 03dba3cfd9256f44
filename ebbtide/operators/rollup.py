"""Roll accounts up to parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.calendar import week_grid
from ebbtide.operators.fact import FACT_MEASURES, on_spine, sum_weeks
from ebbtide.params import RunParams

REPRESENTATIVE_COLUMNS = [
    "customer_id", "volume", "total_spend", "total_num_trx", "last_transaction_month", "state_code",
    "num_of_trucks", "billing_freq", "due_days", "channel_1", "channel_2", "credit_score",
    "product_information_1", "product_information_2", "product_information_3",
    "product_information_4", "product_information_5", "product_information_6", "last_payment_method",
]


def churn_flag(last_week: Column, p: RunParams) -> Column:
    return F.when(last_week > p.churn_cutoff_week, "ACTIVE").otherwise("CHURNER")


def rollup_profile(profile: DataFrame, p: RunParams) -> DataFrame:
    """One row per parent.

    Attributes come from the account with the highest volume, then the most
    transactions, then the latest week, then the lowest account code. Limits of
    several accounts add up; first month and last week are the extremes. All in
    one aggregation, so a parent with very many accounts is combined map-side.
    """
    order = F.struct("volume", "total_num_trx", "last_transaction_week", F.negative("customer_id"))
    picked = F.max_by(F.struct(*REPRESENTATIVE_COLUMNS), order)
    several = F.col("accounts") > 1
    return (
        profile.where(F.col("parentname").isNotNull())
        .groupBy("parentname")
        .agg(
            picked.alias("pick"),
            F.count("*").alias("accounts"),
            F.sum("credit_limit").alias("limits"),
            F.min("first_trx_month").alias("first_trx_month"),
            F.max("last_transaction_week").alias("last_transaction_week"),
            F.max("total_producttype_spend").alias("total_producttype_spend"),
        )
        .select(
            "parentname", "accounts", "pick.*",
            F.when(several, F.coalesce("limits", F.lit(0))).otherwise(F.col("limits")).alias("credit_limit"),
            "first_trx_month", "last_transaction_week", "total_producttype_spend",
            churn_flag(F.col("last_transaction_week"), p).alias("churn_flag"),
        )
    )


def parent_weekly(weeks: DataFrame, parents: DataFrame, p: RunParams) -> DataFrame:
    """(parent, week) fact from account weeks (``fact.account_weeks``).

    Equals rolling up the dense account fact, but only parents, not accounts, are
    spread over the weeks, and the join to parents sees one row per account and week.
    """
    mapping = parents.where(F.col("parentname").isNotNull()).select("customer_id", "parentname")
    mapped = weeks.join(mapping, "customer_id").drop("customer_id")
    spine = week_grid(mapping.select("parentname").distinct(), "parentname", p)
    return on_spine(sum_weeks(mapped, "parentname"), spine, "parentname", FACT_MEASURES)


def orphan_parents(parents: DataFrame, other: DataFrame) -> DataFrame:
    """Parents of one frame that another lacks."""
    return parents.select("parentname").distinct().join(other, "parentname", "left_anti")
