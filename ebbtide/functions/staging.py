"""Stage boundaries written to the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
# Says that a local-looking path is one mount on every machine of a cluster, so that it is not tried.
MOUNTED = "spark.ebbtide.sharedMount"

_fallback: dict[str, str] = {}
_tried: dict[str, Exception | None] = {}
_runs: dict[str, str] = {}
_scopes: dict[str, str] = {}
_tables: dict[str, str] = {}


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """Folder that the driver and all executors reach.

    ``folder`` wins, else the cluster's checkpoint folder, else the warehouse. A
    temporary folder stands in only where driver and executors are one process. On a
    cluster a missing setting is refused, and so is a local path, unless
    ``spark.ebbtide.sharedMount`` says that it is a mount all machines have or a
    trial shows that it is.
    """
    master = spark.sparkContext.master
    folder = folder or _setting(spark, CHECKPOINT_DIR)
    if not folder and master.startswith("local") and not master.startswith("local-cluster"):
        app = spark.sparkContext.applicationId
        return _fallback.setdefault(app, tempfile.mkdtemp(prefix="ebbtide-"))
    folder = folder or _setting(spark, WAREHOUSE_DIR)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    folder = folder.rstrip("/")
    local_path = folder.startswith("file:") or "://" not in folder
    if local_path and not master.startswith("local") and _setting(spark, MOUNTED) != "true":
        _require_shared(spark, folder)
    return folder


def _require_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder in which the driver and the executors do not see each other's files; tried once a run."""
    key = f"{spark.sparkContext.applicationId} {folder}"
    if key not in _tried:
        try:
            _tried[key] = _trial(spark, folder)
        except Exception as error:  # a folder that cannot be written or read is no better
            _tried[key] = error
    if _tried[key] is not None:
        raise ValueError(f"{folder} is a local path that executors do not share; name a shared one or set {MOUNTED}=true") from _tried[key]


def _trial(spark: SparkSession, folder: str) -> Exception | None:
    """A row from every core, written by the executors, listed by the driver and read back."""
    path, n = f"{folder}/ebbtide/trial-{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism
    try:
        spark.range(0, n, 1, n).write.parquet(path)
        seen = spark.read.schema("id long").parquet(path).distinct().count()
        return None if seen == n else FileNotFoundError(f"{seen} of {n} files in {path}")
    finally:
        _delete(spark, path)


def run_folder(spark: SparkSession, folder: str | None = None) -> str:
    """This application's own folder under the shared one; removed when the driver's JVM ends."""
    base = shared_folder(spark, folder)
    key = f"{spark.sparkContext.applicationId} {base}"
    if key not in _runs:
        path = f"{base}/ebbtide/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        hadoop_path, fs = _hadoop(spark, path)
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _runs[key] = path
    return _runs[key]


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def release(spark: SparkSession, folder: str | None = None) -> None:
    """Remove all that this application has staged; frames that still read it become invalid."""
    path = _runs.pop(f"{spark.sparkContext.applicationId} {shared_folder(spark, folder)}", None)
    if path:
        for name in [n for n, at in _tables.items() if at.startswith(path)]:
            _tables.pop(name)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, path)


@contextmanager
def scope(spark: SparkSession, name: str):
    """What is staged inside goes below a folder of its own, so that ``release_scope`` can remove it alone."""
    app = spark.sparkContext.applicationId
    before = _scopes.get(app, "")
    _scopes[app] = f"{name}/"
    try:
        yield
    finally:
        _scopes[app] = before


def release_scope(spark: SparkSession, name: str, still_read: DataFrame | None = None, folder: str | None = None) -> bool:
    """Remove what was staged in a scope, unless ``still_read`` reads from it; says whether it did."""
    path = f"{run_folder(spark, folder)}/{name}/"
    if still_read is not None and any(path in f for f in still_read.inputFiles()):
        return False
    _delete(spark, path)
    return True


def new_path(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A fresh path below the run's folder, in the scope that is open."""
    inside = _scopes.get(spark.sparkContext.applicationId, "")
    return f"{run_folder(spark, folder)}/{inside}{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, keeps column pruning."""
    path = new_path(df.sparkSession, label, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, label: str, key: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once, bucketed and sorted by ``key``, and read it back as a table.

    Aggregates by the key and joins of such tables on it need no exchange. There are
    as many buckets as shuffle partitions, one file each; for keys with a bounded
    number of rows, as a bucket is one task.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = new_path(spark, label, folder), f"ebbtide_{label}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    rows.option("path", path).saveAsTable(name)
    _tables[name] = path
    return spark.table(name)
