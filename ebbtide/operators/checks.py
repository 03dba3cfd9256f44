"""Stage invariants: as a table of checks, and as conditions that stop the run that breaks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_row_per(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Row count equals distinct key count."""
    return rows.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys")).select(
        F.lit(name).alias("check"), "rows", F.col("keys").alias("expected"), (F.col("rows") == F.col("keys")).alias("ok")
    )


def no_orphans(rows: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Every key of ``rows`` exists in ``other``."""
    orphans = rows.select(key).distinct().join(other.select(key), key, "left_anti")
    return orphans.agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("check"), "rows", F.lit(0).cast("long").alias("expected"), (F.col("rows") == 0).alias("ok")
    )


def not_empty(rows: DataFrame, name: str) -> DataFrame:
    return rows.limit(1).agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("check"), "rows", F.lit(1).cast("long").alias("expected"), (F.col("rows") == 1).alias("ok")
    )


def required(rows: DataFrame, holds: Column, message: str) -> DataFrame:
    """``rows``, whose reading fails with ``message`` at a row where ``holds`` is not true; no pass of its own."""
    return rows.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def required_unique(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows``, whose reading fails where ``key`` is null or repeats; for keys with a bounded number of rows."""
    named = required(rows, F.col(key).isNotNull(), f"{name}: {key} is null")
    counted = named.withColumn("_rows", F.count("*").over(Window.partitionBy(key)))
    return required(counted, F.col("_rows") == 1, f"{name}: {key} repeats").drop("_rows")


def stage_invariants(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
