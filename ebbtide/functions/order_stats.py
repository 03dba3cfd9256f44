"""Exact ranks and quantiles that never put a whole group into one task.

Everything rests on :func:`value_positions`: the distinct values of each group
with their counts and the number of rows below them. The distinct values are cut
into ranges whose number grows with theirs, ordered within each range, and shifted
by the sums of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage

# Distinct values that one range holds on average.
PIECE_VALUES = 200_000


def value_positions(rows: DataFrame, group: list[str], value: str, piece_values: int = PIECE_VALUES) -> DataFrame:
    """One row per (group, value): ``n`` rows, ``below`` rows and ``dense`` rank.

    Null values are left out. ``dense`` starts at 1 for the smallest value. A
    repeated value is one row, so ties of any number do not matter.
    """
    present = rows.where(F.col(value).isNotNull())
    counts = stage(present.groupBy(*group, value).agg(F.count("*").alias("n")), "counts")
    pieces = counts.count() // piece_values + 1
    # Ranges of (group, value): a group of any size spreads over as many as it needs.
    ranged = counts.repartitionByRange(pieces, *group, value).withColumn("piece", F.spark_partition_id())
    cut = stage(ranged, "ranges")
    # One row per group and range it touches.
    sizes = cut.groupBy(*group, "piece").agg(F.sum("n").alias("rows"), F.count("*").alias("values"))
    earlier = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group, "piece",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("values").over(earlier), F.lit(0)).alias("values_before"),
    )
    within = Window.partitionBy(*group, "piece").orderBy(value)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({
        "below": F.coalesce(F.sum("n").over(before), F.lit(0)), "dense": F.row_number().over(within),
    })
    return local.join(offsets, [*group, "piece"]).select(
        *group, value, "n",
        (F.col("below") + F.col("rows_before")).alias("below"),
        (F.col("dense") + F.col("values_before")).alias("dense"),
    )


def dense_ranks(rows: DataFrame, key: str, group: str, columns: dict[str, str], descending: bool = True) -> DataFrame:
    """(key, rank columns): dense rank of each column in its group, null for null values.

    ``columns`` maps a value column to the name of its rank. All columns are
    ranked in one pass over (group, column, value).
    """
    sign = "-" if descending else ""
    signed = rows.selectExpr(key, group, *[f"{sign}CAST({c} AS DOUBLE) AS {name}" for c, name in columns.items()])
    long = signed.unpivot([key, group], list(columns.values()), "measure", "value").where(F.col("value").isNotNull())
    places = value_positions(long, [group, "measure"], "value")
    ranked = long.join(places.select(group, "measure", "value", "dense"), [group, "measure", "value"])
    return ranked.groupBy(key).agg(
        *[F.max(F.when(F.col("measure") == name, F.col("dense"))).cast("long").alias(name) for name in columns.values()]
    )


def percentile_ranks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, measure, value, pct): average rank over the non-null count, ties shared."""
    long = rows.unpivot([key], columns, "measure", "value").where(F.col("value").isNotNull())
    places = value_positions(long, ["measure"], "value")
    totals = places.groupBy("measure").agg(F.sum("n").alias("total"))
    pct = places.join(F.broadcast(totals), "measure").select(
        "measure", "value",
        ((F.col("below") + (F.col("n") + 1) / 2) / F.col("total")).alias("pct"),
    )
    return long.join(pct, ["measure", "value"]).select(key, "measure", "value", "pct")


def quantiles(rows: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """(measure, p, lower, upper, value): exact quantiles, linear interpolation.

    ``lower`` and ``upper`` are the two neighbouring order statistics.
    """
    names = [F.col(f"`{c}`") for c in columns]
    long = rows.select([n.cast("double").alias(c) for n, c in zip(names, columns)])
    long = long.unpivot([], names, "measure", "value").where(F.col("value").isNotNull())
    places = value_positions(long, ["measure"], "value")
    totals = places.groupBy("measure").agg(F.sum("n").alias("total"))
    wanted = totals.select(
        "measure", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"), "total"
    ).select(
        "measure", "p",
        F.floor(F.col("p") * (F.col("total") - 1)).alias("lo"),
        F.ceil(F.col("p") * (F.col("total") - 1)).alias("hi"),
        (F.col("p") * (F.col("total") - 1) - F.floor(F.col("p") * (F.col("total") - 1))).alias("fraction"),
    )
    # A handful of positions per column is asked for, so this side stays tiny.
    holds_lo = (F.col("below") <= F.col("lo")) & (F.col("lo") < F.col("below") + F.col("n"))
    holds_hi = (F.col("below") <= F.col("hi")) & (F.col("hi") < F.col("below") + F.col("n"))
    found = (
        places.join(F.broadcast(wanted), "measure")
        .where(holds_lo | holds_hi)
        .groupBy("measure", "p", "fraction")
        .agg(F.min("value").alias("lower"), F.max("value").alias("upper"))
    )
    return found.select(
        "measure", "p", "lower", "upper",
        (F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("fraction")).alias("value"),
    )


def quartile_scores(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add ``{column}_score``: quartile 1..4 of the non-zero values, else 0.

    Repeated quartile edges are merged; a column with a single edge scores 0.
    """
    edges = (
        quantiles(rows.select([F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in columns]), columns, [0, 0.25, 0.5, 0.75, 1])
        .groupBy("measure")
        .agg(F.array_sort(F.collect_set("value")).alias("edges"))
    )
    # One array in the order of the columns: a column finds its edges by its place.
    places = F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("place", "measure")
    named = rows.sparkSession.range(1).select(places).join(F.broadcast(edges), "measure", "left")
    fitted = named.agg(F.array_sort(F.collect_list(F.struct("place", "edges")))).scalar()
    scored = rows.withColumn("_edges", fitted)
    for place, c in enumerate(columns):
        mine = F.get("_edges", F.lit(place))["edges"]
        score = F.greatest(F.lit(1), F.size(F.filter(mine, lambda e: e < F.col(c))))
        usable = F.col(c).isNotNull() & (F.col(c) != 0) & (F.size(mine) >= 2)
        scored = scored.withColumn(_score_name(c), F.when(usable, score).otherwise(0).cast("int"))
    return scored.drop("_edges")


def _score_name(column: str) -> str:
    return column.removesuffix("_avg") + "_score"
