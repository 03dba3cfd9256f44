"""The wide feature table: one row per parent, six families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.params import RunParams


def full_outer_features(families: list[DataFrame]) -> DataFrame:
    """Families side by side for every parent any of them knows; missing numbers are zero."""
    joined = families[0]
    for family in families[1:]:
        joined = joined.join(family, "parentname", "full_outer")
    return joined.na.fill(0)


def feature_table(families: list[DataFrame], p: RunParams, recent_only: bool = True) -> DataFrame:
    """Inner join of all families, churn label 0/1, and the recency cut unless training."""
    joined = families[0]
    for family in families[1:]:
        joined = joined.join(family, "parentname")
    label = F.when(F.col("last_transaction_week") > p.churn_cutoff_week, 0).otherwise(1)
    labelled = joined.na.fill(0).withColumn("churn_flag", label)
    if recent_only and not p.random_cutoff:
        return labelled.where(F.col("last_transaction_week") > p.recency_cutoff_week)
    return labelled
