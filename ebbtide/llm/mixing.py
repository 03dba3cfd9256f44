"""Mixing sources to target weights.

Documents get a hash-random key. Within a source they are cut into key ranges
of about equal row counts; sums per range and a running sum inside each range
give every document its place on the source's line of words. The source's budget
is cut on that line exactly, after as many whole epochs as fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import free_name, q

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Rows that one key range holds on average.
RANGE_ROWS = 4096
SEED = "mix:"


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size, source_rows): weights repeat by code point of the source, null last.

    The whole size is shared by weight; no target exceeds ``max_epochs`` times its
    source, and what is cut off is shared again by weight. Sources are capped in
    ascending order of cap per weight, so running sums give the final share at once.
    The windows see one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    given = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("weight", F.element_at(given, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    capped = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shares = (
        capped.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "is_capped",
            F.col("cap").cast("double") * (F.col("all_weight") - F.col("weight_before"))
            <= F.col("weight").cast("double") * (F.col("all_size") - F.col("cap_before")),
        )
    )
    left_size = F.col("all_size") - F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("cap"))).over(everything), F.lit(0))
    left_weight = F.col("all_weight") - F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("weight"))).over(everything), F.lit(0))
    share = left_size.cast("double") * F.col("weight") / left_weight
    return shares.withColumn(
        "target", F.when(F.col("is_capped"), F.col("cap").cast("double")).otherwise(share)
    ).select("source", "source_size", "source_rows", "weight", "target")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS, carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and taken.

    The order within a source is by md5 of the id (null as empty), then id, so
    reruns agree; rows that repeat an id keep their own places, and which of them
    comes first is decided by md5 of their text. The document at the cut gives only
    the words up to it. A null text has size 0 and takes nothing; a null source is a
    source of its own; an empty input gives no rows. An input column with the name
    of a result column is replaced by the result; ``carry`` names the columns to keep,
    the id and the source among them, where not all are wanted.
    """
    results = {"size", "source_size", "target", "taken"}
    carried = [c for c in (carry or docs.columns) if c.lower() not in results]
    key, tie = free_name(docs.columns, "mix_key"), free_name(docs.columns, "mix_tie")
    text = F.coalesce(F.col(q(text_col)), F.lit(""))
    rows = stage(
        docs.select(
            *[q(c) for c in carried],
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(q(id_col)).cast("string"), F.lit("")))).alias(key),
            F.md5(text).alias(tie),
        ),
        "mix-rows",
    )
    totals = rows.groupBy(F.col(q(source_col)).alias("source")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    targets = stage(source_targets(totals, weights, max_epochs), "mix-targets").select(
        F.col("source").alias("mix_source"), "source_size", "target",
        F.ceil(F.col("source_rows") / range_rows).alias("mix_ranges"),
    )
    # The first 32 bits of the key are uniform: equal key ranges hold about equal rows, also of a hot source.
    position = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    placed = rows.join(targets, F.col(q(source_col)).eqNullSafe(F.col("mix_source"))).withColumn(
        "mix_range", F.floor(position * F.col("mix_ranges") / F.lit(2**32)).cast("long")
    )
    per_range = placed.groupBy("mix_source", "mix_range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("mix_source").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        F.col("mix_source").alias("o_source"), F.col("mix_range").alias("o_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_before"),
    )
    inside = (
        Window.partitionBy("mix_source", "mix_range").orderBy(key, q(id_col), tie)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lined = placed.withColumn("inside_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, F.col("mix_source").eqNullSafe(F.col("o_source")) & (F.col("mix_range") == F.col("o_range"))
    )
    before = F.col("range_before") + F.col("inside_before")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    cut = F.floor(F.col("target") - full * F.col("source_size") + 0.5).cast("long")
    rest = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), cut - before))
    return lined.select(
        *[q(c) for c in carried], "size", "source_size", "target", (full * F.col("size") + rest).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document and epoch in which the mix takes words of it, with ``epoch`` and ``epoch_words``.

    ``epoch_words`` is below ``size`` only for the document at its source's cut: a
    reader stops there. Documents of which nothing is taken have no row.
    """
    mixed = mix_sources(docs, id_col, text_col, source_col).where("taken > 0")
    columns = [c for c in mixed.columns if c.lower() not in ("epoch", "epoch_words")]
    epochs = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    return mixed.select(*[q(c) for c in columns], F.explode(epochs).alias("epoch")).withColumn(
        "epoch_words", F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    )
