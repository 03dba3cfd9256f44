"""Result sinks: replaceable slices, appends, sidecars and feature lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = ["run_week", "run_date"]

RESULT_SCHEMA = T.StructType([
    T.StructField("parentname", T.StringType(), False),
    T.StructField("first_trx_month", T.IntegerType()),
    T.StructField("last_transaction_week", T.IntegerType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("num_of_trucks", T.StringType()),
    T.StructField("credit_limit", T.IntegerType()),
    T.StructField("billing_freq", T.StringType()),
    T.StructField("due_days", T.IntegerType()),
    T.StructField("credit_grade", T.StringType()),
    T.StructField("tenure", T.FloatType()),
    T.StructField("channel", T.StringType()),
    T.StructField("product_type_most_frequent", T.StringType()),
    T.StructField("last_payment_method", T.StringType()),
    T.StructField("churn_flag_actual", T.IntegerType()),
    T.StructField("churn_flag_predicted", T.IntegerType()),
    T.StructField("churn_prob", T.FloatType()),
    T.StructField("churn_rank", T.IntegerType()),
    *[T.StructField(f"factor_{n}", T.StringType()) for n in range(1, 11)],
    T.StructField("customer_size", T.StringType()),
    T.StructField("run_week", T.StringType()),
    T.StructField("run_date", T.TimestampType()),
])


def as_result(scores: DataFrame) -> DataFrame:
    """Columns and types of the result table; absent columns are null."""
    present = set(scores.columns)
    return scores.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA
    ])


def stamp(rows: DataFrame, run_week: int, run_date: dt.date) -> DataFrame:
    return rows.withColumns({"run_week": F.lit(str(run_week)), "run_date": F.lit(run_date)})


def replace_slice(rows: DataFrame, path: str, run_week: int, run_date: dt.date) -> None:
    """Stamp ``rows`` with one (run_week, run_date) and let them replace that slice, also when there are none.

    The new slice is written beside the old one and takes its place when the write is
    committed, so a write that fails leaves the old slice. Only an empty batch, which
    writes no slice, removes the old one, after its write has succeeded.
    """
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run_week={run_week}/run_date={run_date.isoformat()}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def files() -> set[str]:
        return {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()

    old = files()
    slices = stamp(rows, run_week, run_date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    slices.partitionBy(*SLICE).parquet(path)
    # Every write names its files anew: those still there were not replaced, as nothing was written.
    if old and files() == old:
        fs.delete(folder, True)


def read_result(spark, path: str) -> DataFrame:
    """The result table in its declared types."""
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def append_table(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").saveAsTable(table)


def write_archive(rows: DataFrame, path: str, run_date: dt.date) -> None:
    """One write serves as current copy and archive: a partition per run date."""
    replace = rows.withColumn("run_date", F.lit(run_date))
    replace.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def write_params(rows: DataFrame, path: str) -> None:
    """Run parameters as a one-row JSON sidecar."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def write_feature_lists(lists: DataFrame, path: str) -> None:
    """(name, features) rows as JSON; read back with ``read_feature_lists``."""
    lists.write.mode("overwrite").json(path)


def read_feature_lists(spark, path: str) -> DataFrame:
    return spark.read.schema("name string, features array<string>").json(path)
