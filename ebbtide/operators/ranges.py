"""Active parents, lifetime bounds and trailing week ranges.

All windows run per parent over at most one row per week of history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.params import RunParams

RANGE_LENGTHS = [4, 8, 13, 26]
NONZERO_ACTIVITY = [
    "total_nonfuel_spend", "total_ecashspend", "total_vcomcheckspend", "total_comcheck_spend", "total_vcap_spend",
]
FULL_LENGTH = 52


def is_active_week() -> Column:
    active = F.col("total_gallons") > 0
    for name in NONZERO_ACTIVITY:
        active = active | (F.col(name) != 0)
    return active


def active_parents(weekly: DataFrame, min_weeks: int) -> DataFrame:
    """Parents with enough active weeks."""
    counts = weekly.groupBy("parentname").agg(F.count(F.when(is_active_week(), 1)).alias("active_weeks"))
    return counts.where(F.col("active_weeks") >= min_weeks)


def lifetime_bounds(weekly: DataFrame, min_weeks: int) -> DataFrame:
    """Weeks between the first and last active week of sufficiently active parents."""
    parent = Window.partitionBy("parentname")
    active_week = F.when(is_active_week(), F.col("week"))
    bounded = weekly.withColumns({
        "_active_weeks": F.count(active_week).over(parent),
        "min_lifetime_week": F.min(active_week).over(parent),
        "max_lifetime_week": F.max(active_week).over(parent),
    })
    kept = (F.col("_active_weeks") >= min_weeks) & F.col("week").between(F.col("min_lifetime_week"), F.col("max_lifetime_week"))
    return bounded.where(kept).drop("_active_weeks")


def seeded_draw(parent: Column, seed: int) -> Column:
    """Repeatable 32-bit number of a parent."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), parent).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long")


def random_cutoff(trimmed: DataFrame, status: DataFrame, p: RunParams) -> DataFrame:
    """Cut an active parent's history at a drawn week; churned parents keep all.

    ``status`` is (parentname, churn_flag). The drawn last rank lies in
    [max(min_weeks - 1, n - 52), n) for n weeks, so it is never the last one.
    """
    parent = Window.partitionBy("parentname")
    low = F.greatest(F.lit(p.min_weeks - 1), F.col("_weeks") - FULL_LENGTH)
    drawn = low + F.pmod(seeded_draw(F.col("parentname"), p.seed), F.greatest(F.lit(1), F.col("_weeks") - low))
    last_rank = F.when((F.col("churn_flag") == "ACTIVE") & (F.col("_weeks") > low), drawn).otherwise(F.col("_weeks"))
    # The status side has one row per parent; the trimmed weeks are few per parent.
    joined = trimmed.join(status.select("parentname", "churn_flag"), "parentname", "left")
    ranked = joined.withColumns({
        "_weeks": F.count("*").over(parent),
        "_rank": F.row_number().over(parent.orderBy("week")),
    })
    return ranked.where(F.col("_rank") <= last_rank).drop("_weeks", "_rank", "churn_flag")


def range_label(rank: Column, length: int, offset: int) -> Column:
    label = F.when(rank.between(1 + offset, length + offset), "range-1")
    if length < FULL_LENGTH:
        label = label.when(rank.between(length + offset + 1, 2 * length + offset), "range-2")
    return label


def week_ranges(trimmed: DataFrame, p: RunParams) -> DataFrame:
    """Rank weeks newest first and label the trailing ranges.

    Weeks inside the offset or older than 52 + offset are dropped; a parent must
    keep ``min_weeks`` rows, active or not.
    """
    parent = Window.partitionBy("parentname")
    ranked = trimmed.withColumn("week_rank", F.row_number().over(parent.orderBy(F.desc("week"))))
    labels = {f"week_range_{n}": range_label(F.col("week_rank"), n, p.offset) for n in [*RANGE_LENGTHS, FULL_LENGTH]}
    kept = ranked.where(F.col("week_rank").between(1 + p.offset, FULL_LENGTH + p.offset))
    counted = kept.withColumns(labels).withColumn("_rows", F.count("*").over(parent))
    return counted.where(F.col("_rows") >= p.min_weeks).drop("_rows")


def labelled_weeks(weekly: DataFrame, p: RunParams, status: DataFrame | None = None) -> DataFrame:
    """From the parent fact to labelled weeks."""
    trimmed = lifetime_bounds(weekly, p.min_weeks)
    if p.random_cutoff:
        trimmed = random_cutoff(trimmed, status, p)
    return week_ranges(trimmed, p)


def last_weeks(labelled: DataFrame) -> DataFrame:
    """Newest kept week of each parent."""
    return labelled.groupBy("parentname").agg(F.max("week").alias("week"))


def in_range(length: int, label: str = "range-1") -> Column:
    return F.col(f"week_range_{length}") == label
