"""Seventeen cleaned profile columns per parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import labels
from ebbtide.functions.order_stats import quantiles
from ebbtide.functions.rounding import half_even
from ebbtide.functions.weeks import month_first_day

STATIC_FEATURES = [
    "parentname", "first_trx_month", "last_transaction_week", "last_transaction_month", "state_code",
    "num_of_trucks", "credit_limit", "billing_freq", "due_days", "credit_grade", "tenure", "channel",
    "product_type_most_frequent", "churn_flag", "customer_size", "customer_segment", "last_payment_method",
]


def medians(profile: DataFrame, columns: list[str]) -> DataFrame:
    """One row: exact median per column, and the lower of its two middle values."""
    found = quantiles(profile, columns, [0.5])
    return found.groupBy().agg(
        *[F.max(F.when(F.col("measure") == c, F.col("value"))).alias(f"{c}_median") for c in columns],
        *[F.max(F.when(F.col("measure") == c, F.col("lower"))).alias(f"{c}_lower") for c in columns],
    )


def _as_value(row: DataFrame) -> Column:
    """A one-row frame as a struct value inside another frame's plan."""
    return row.select(F.struct(*row.columns).alias("row")).scalar()


def _valid_month(median: Column, lower: Column) -> Column:
    """A median between two months may be no month at all; the earlier one stands in."""
    month = F.pmod(median.cast("long"), F.lit(100))
    whole = median == F.floor(median)
    return F.when(whole & month.between(1, 12), median).otherwise(lower).cast("int")


def impute(profile: DataFrame) -> DataFrame:
    """Fill first month, due days and credit limit by exact medians.

    The credit limit is filled twice: missing by the median, then zero by the
    median of the filled column.
    """
    first = medians(profile, ["first_trx_month", "due_days", "credit_limit"])
    filled = profile.withColumn("_m", _as_value(first)).withColumns({
        "first_trx_month": F.coalesce("first_trx_month", _valid_month(F.col("_m.first_trx_month_median"), F.col("_m.first_trx_month_lower"))),
        "due_days": F.coalesce(F.col("due_days").cast("double"), "_m.due_days_median").cast("long"),
        "credit_limit": F.coalesce(F.col("credit_limit").cast("double"), "_m.credit_limit_median"),
    }).drop("_m")
    second = medians(filled.select("credit_limit"), ["credit_limit"])
    zero_filled = F.when(F.col("credit_limit") == 0, F.col("_m.credit_limit_median")).otherwise(F.col("credit_limit"))
    return filled.withColumn("_m", _as_value(second)).withColumn("credit_limit", zero_filled.cast("long")).drop("_m")


def static_features(profile: DataFrame, last_weeks: DataFrame, month_of_week: DataFrame) -> DataFrame:
    """Clean the parent profile; parents without labelled weeks drop out.

    ``profile`` is read several times and should be staged.
    """
    months = last_weeks.join(F.broadcast(month_of_week), "week", "left").select("parentname", "yearmonth")
    joined = impute(profile).join(months, "parentname")
    days = F.datediff(month_first_day(F.col("yearmonth")), month_first_day(F.col("first_trx_month")))
    tenure = half_even(days / 365, 2)
    band = labels.truck_band(F.col("num_of_trucks"))
    products = [F.col(f"product_information_{n}") for n in range(1, 7)]
    return joined.select(
        "parentname", "first_trx_month", "last_transaction_week", "last_transaction_month",
        labels.state_group(F.col("state_code")).alias("state_code"),
        band.alias("num_of_trucks"),
        "credit_limit",
        labels.billing_frequency(F.col("billing_freq")).alias("billing_freq"),
        "due_days",
        labels.credit_grade(F.col("credit_score")).alias("credit_grade"),
        tenure.alias("tenure"),
        labels.channel_class(F.col("channel_1"), F.col("channel_2")).alias("channel"),
        labels.product_bucket(labels.product_combination(products)).alias("product_type_most_frequent"),
        F.when(F.col("churn_flag") == "ACTIVE", 0).otherwise(1).alias("churn_flag"),
        labels.customer_size(band).alias("customer_size"),
        F.when(tenure <= 1, "NEW").otherwise("EXISTING").alias("customer_segment"),
        labels.payment_group(F.col("last_payment_method")).alias("last_payment_method"),
    )
