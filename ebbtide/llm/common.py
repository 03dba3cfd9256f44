"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Rows in one Arrow batch: keeps a Python task's memory near a thousand texts.
BATCH_ROWS = 1000
# Arrays of fixed size that one task, or the driver, merges.
FAN_IN = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of ``rows`` rows for the jobs that run inside; then the session's own setting again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(taken: list[str], stem: str) -> str:
    """A column name that no input column has, compared without case."""
    used = {c.lower() for c in taken}
    name, k = stem, 0
    while name.lower() in used:
        k += 1
        name = f"{stem}_{k}"
    return name


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merged_arrays(blobs: DataFrame, merge, dtype) -> np.ndarray | None:
    """All arrays in the column ``blob`` merged into one, some at a time."""

    def total(values):
        found = None
        for value in values:
            part = np.frombuffer(zlib.decompress(value), dtype)
            found = part if found is None else merge(found, part)
        return found

    def several(batches):
        found = total(v for batch in batches for v in batch.column("blob").to_pylist())
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(found.tobytes(), 1)], pa.binary())], ["blob"])

    n = blobs.count()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        blobs = stage(blobs.repartition(n).mapInArrow(several, "blob binary"), "merged")
    return total(r.blob for r in blobs.collect())
