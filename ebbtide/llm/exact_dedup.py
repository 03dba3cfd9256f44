"""Exact deduplication with a split for heavy hitters.

A Misra-Gries sketch over the text digests finds the digests that many rows
share. Their exact counts and winners are few by the sketch's own bound, so they
are broadcast and decide those rows where they lie. All other digests are rare
and go through an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import free_name, lower_ascii, q

# Counters of one sketch: a digest on more than rows / (0.75 * COUNTERS) rows is always found.
COUNTERS = 4096
# Sketches that are merged by one task.
FAN_IN = 64
RESULTS = {"keep_id", "group_size", "kept", "text_sha256"}


def frequent_keys(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of the long column ``key`` that may be frequent, none missed above the bound."""
    sketches = keys.groupBy(F.spark_partition_id().alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(key, {counters})").alias("sketch")
    )
    # Two levels: no task merges the sketches of all partitions of a large input.
    merged = sketches.groupBy(F.floor(F.col("part") / FAN_IN).alias("part")).agg(
        F.expr("approx_top_k_combine(sketch)").alias("sketch")
    )
    # Grouped by a constant: a global aggregate would merge empty buffers of empty partitions, which this sketch refuses.
    top = merged.groupBy(F.lit(0).alias("one")).agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"))
    items = top.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters})")).alias("item"))
    return items.where("item.count > 1").select(F.col("item.item").alias("key")).distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id is kept; a row without id is kept
    only where no equal row has one, and of rows that repeat the same id exactly
    one is kept. An empty input gives no rows. An input column with the name of a
    result column is replaced by the result; ``carry`` names the columns to keep, the id
    among them, where not all are wanted.
    """
    carried = [c for c in (carry or docs.columns) if c.lower() not in RESULTS]
    digest, row = free_name(docs.columns, "digest"), free_name(docs.columns, "row")
    rows = stage(
        docs.withColumn(digest, F.unhex(F.sha2(lower_ascii(F.col(q(text_col))), 256)))
        .withColumn(row, F.monotonically_increasing_id())
        .select(*[q(c) for c in carried], q(digest), q(row)),
        "exact-rows",
    )
    best = F.struct(F.col(q(id_col)), F.col(q(row)))
    key = F.xxhash64(F.col(q(digest)))
    candidates = frequent_keys(rows.select(key.alias("key")), counters)
    # At most one key per counter, so the verified winners are a bounded broadcast.
    winners = stage(
        rows.select(digest, best.alias("best"), key.alias("key"))
        .join(F.broadcast(candidates), "key", "left_semi")
        .groupBy(digest)
        .agg(F.count("*").alias("group_size"), F.max("best").alias("best"))
        .orderBy(F.desc("group_size"))
        .limit(counters)
        .where("group_size > 1"),
        "exact-winners",
    )
    heavy = rows.join(F.broadcast(winners), digest)
    group = Window.partitionBy(digest)
    light = (
        rows.join(F.broadcast(winners.select(digest)), digest, "left_anti")
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("best", F.max(best).over(group))
    )
    columns = [F.col(q(c)) for c in carried] + [
        F.col(f"best.{q(id_col)}").alias("keep_id"),
        F.col("group_size"),
        (F.col(f"best.{q(row)}") == F.col(q(row))).alias("kept"),
        F.lower(F.hex(q(digest))).alias("text_sha256"),
    ]
    return heavy.select(*columns).unionByName(light.select(*columns))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` in its own columns.

    Of equal texts one row stays, as in ``exact_duplicates``. Columns with the names of its
    results keep their own values. An empty input gives no rows.
    """
    taken = [*docs.columns, *RESULTS]
    own = {}
    for c in docs.columns:
        if c.lower() in RESULTS:
            own[c] = free_name(taken, "own")
            taken.append(own[c])
    moved = docs.withColumnsRenamed(own)
    marked = exact_duplicates(moved, own.get(id_col, id_col), own.get(text_col, text_col))
    return marked.where("kept").select(*[F.col(q(own.get(c, c))).alias(c) for c in docs.columns])
