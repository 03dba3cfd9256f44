"""Parquet tables by name, and typed CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """Access to ``<root>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._read[name]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def within_days(column: str, days: tuple[dt.date, dt.date] | None) -> Column:
    """Half-open range on a zone-less timestamp, in a form the Parquet scan can use."""
    if days is None:
        return F.lit(True)
    low, high = days
    return F.expr(f"{column} >= timestamp_ntz'{low} 00:00:00' AND {column} < timestamp_ntz'{high} 00:00:00'")
