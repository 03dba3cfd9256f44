"""Fiscal calendar and the lookups on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import weeks as wk
from ebbtide.params import RunParams


def fiscal_calendar(spark: SparkSession, p: RunParams) -> DataFrame:
    """One row per week: ``week_starts, week_no, year, fm_month, fm_week``."""
    mondays = p.mondays
    day = F.date_add(F.lit(mondays[0]), (F.col("id") * 7).cast("int"))
    key = wk.week_key(F.col("week_starts"))
    return spark.range(len(mondays), numPartitions=1).select(day.alias("week_starts")).select(
        "week_starts", key.alias("week_no"),
        F.year("week_starts").alias("year"), F.month("week_starts").alias("fm_month"),
        (key - F.year("week_starts") * 100).cast("int").alias("fm_week"),
    )


def with_week(rows: DataFrame, day: Column, calendar: DataFrame, how: str = "inner", columns: dict[str, str] | None = None) -> DataFrame:
    """Attach calendar columns to dated rows.

    The calendar has one row per week of business, so it is always broadcast.
    """
    names = columns or {"week_no": "week"}
    side = calendar.select(F.col("week_starts").alias("_monday"), *[F.col(c).alias(n) for c, n in names.items()])
    return rows.join(F.broadcast(side), F.trunc(day, "week") == F.col("_monday"), how).drop("_monday")


def month_of_week(calendar: DataFrame) -> DataFrame:
    """(yearmonth, week) of every calendar week."""
    return calendar.select(
        (F.col("year") * 100 + F.col("fm_month")).cast("int").alias("yearmonth"), F.col("week_no").alias("week")
    )


def week_grid(keys: DataFrame, key: str, p: RunParams) -> DataFrame:
    """Every key with every week of the history: a list of about 105 weeks, exploded."""
    week_list = F.array(*[F.lit(wk.week_key_of(m)) for m in p.history_mondays])
    month_list = F.array(*[F.lit(m.year * 100 + m.month) for m in p.history_mondays])
    pairs = F.arrays_zip(week_list.alias("week"), month_list.alias("month"))
    return keys.select(key, F.inline(pairs).alias("week", "month"))


def latest_common_week(platform_days: DataFrame, calendar: DataFrame, churn_weeks: int = 2) -> DataFrame:
    """One row: the earliest of the platforms' last weeks and the churn cut-off."""
    last = with_week(platform_days, F.col("last_day"), calendar)
    return last.agg(F.min("week").alias("current_week")).select(
        "current_week", wk.week_minus(F.col("current_week"), churn_weeks).alias("churn_cutoff_week")
    )
