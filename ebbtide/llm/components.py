"""Connected components by alternating large-star and small-star steps.

Each step sends the neighbours of a node to the smallest of them, so stars of any
size shrink by joins on narrow rows and partial aggregates; no node's neighbours
are ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage


def _star(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    return pairs.join(smallest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    large = _star(both.where("v > u"), smallest).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    kept = least.select("u", F.col("m").alias("v"))
    return kept.unionByName(_star(large, least).where("u > v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the smallest node reachable.

    Self links and repeated links do no harm; links with a null end are ignored.
    """
    plain = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    current = stage(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        current = stage(_step(current), "links")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
