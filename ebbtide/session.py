"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning is what copes with hot join keys and partition counts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables in buckets of parents join on (parent, week) where they are; a parent has a bounded number of weeks.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Shuffles start with this many partitions per core, or as many as are set if that is more; adaptive planning merges small ones, it adds none.
PARTITIONS_PER_CORE = 4

# Merged partitions hold this much at most, or what is set if that is less: rows of many short columns take some ten times
# as much when they are sorted, and every task of an executor does so at once.
MERGED_BYTES = 16 * 2**20
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    """A size as Spark's settings give it: a number of bytes, or one with a unit as in 64m, 64MB or 67108864b."""
    digits = size.strip().lower().rstrip("bkmgtp")
    unit = size.strip().lower()[len(digits):][:1] or "b"
    return int(digits) * 1024 ** "bkmgtp".index(unit)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(wanted, given)))
    spark.conf.set(MERGED, str(min(_bytes(spark.conf.get(MERGED)), MERGED_BYTES)))
    return spark


def local_session(cores: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ebbtide")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
