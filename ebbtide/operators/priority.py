"""Outreach priority of parents, and of the accounts of one parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.order_stats import dense_ranks, percentile_ranks
from ebbtide.functions.ratios import SUM_DECIMALS
from ebbtide.functions.staging import stage

# Right-closed bins, the first one closed on both sides.
BIN_EDGES = [0.2, 0.4, 0.6, 0.8, 1.0]
BIN_LABELS = ["0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1"]
BIN_COLUMNS = ["churn_bin_0_0_2", "churn_bin_0_2_0_4", "churn_bin_0_4_0_6", "churn_bin_0_6_0_8", "churn_bin_0_8_1"]
GRAND_TOTAL = "Grand Total"
RANKED_COLUMNS = [
    "last_52_weeks_gallons_x", "last_52_weeks_gallons_max_x", "last_52_weeks_revenue_x", "last_52_weeks_revenue_max_x",
]
RANK_NAMES = {
    "last_transaction_week": "rank_last_transaction_week",
    "last_52_weeks_revenue_y": "rank_revenue",
    "last_52_weeks_gallons_y": "rank_gallons",
    "count_sf_cases_last3m": "rank_sf_cases",
    "decline_pct": "rank_decline",
}


def bin_label(value: Column) -> Column:
    label = F.when((value >= 0) & (value <= BIN_EDGES[0]), BIN_LABELS[0])
    for low, high, name in zip(BIN_EDGES, BIN_EDGES[1:], BIN_LABELS[1:]):
        label = label.when((value > low) & (value <= high), name)
    return label


def parent_frame(combined: DataFrame) -> DataFrame:
    """One row per parent with gallons; the parent columns repeat on each account."""
    columns = ["churn_prob_x", *RANKED_COLUMNS]
    parents = combined.groupBy(F.col("parentname_x").alias("parentname")).agg(
        F.first(F.struct(*columns)).alias("_row")
    ).select("parentname", "_row.*")
    return parents.where("last_52_weeks_gallons_x IS NOT NULL AND last_52_weeks_gallons_x <> 0")


def parent_pct_rank(parents: DataFrame) -> DataFrame:
    """Percentile rank of each of the four volume columns, ties averaged."""
    ranks = percentile_ranks(parents, "parentname", RANKED_COLUMNS)
    return ranks.groupBy("parentname").agg(
        *[F.max(F.when(F.col("measure") == c, F.col("pct"))).alias(f"{c.removesuffix('_x')}_pct") for c in RANKED_COLUMNS]
    )


def parent_priority(combined: DataFrame) -> DataFrame:
    """Priority, bins and rank per parent. ``combined`` should be staged."""
    parents = parent_frame(combined)
    pct = [f"{c.removesuffix('_x')}_pct" for c in RANKED_COLUMNS]
    ranked = parents.join(parent_pct_rank(parents), "parentname").withColumn(
        "priority", F.col("churn_prob_x") * F.greatest(*pct)
    ).withColumns({
        "churn_prob_bin": bin_label(F.col("churn_prob_x")),
        "priority_bin": bin_label(F.col("priority")),
        "revenue_bin": bin_label(F.col("last_52_weeks_revenue_pct")),
    })
    # At most 25 pairs of bins exist; the label text sorts like the bin.
    pairs = ranked.select("priority_bin", "churn_prob_bin").distinct()
    order = Window.orderBy(F.desc("priority_bin"), F.desc("churn_prob_bin"))
    pairs = pairs.where("priority_bin IS NOT NULL AND churn_prob_bin IS NOT NULL").withColumn("parent_rank", F.dense_rank().over(order))
    return ranked.join(F.broadcast(pairs), ["priority_bin", "churn_prob_bin"], "left")


def _pivot(rows: DataFrame, index: str, value: Column) -> DataFrame:
    """Five by five cells with a total row and column; empty cells are zero."""
    cells = [
        F.coalesce(F.sum(F.when(F.col("churn_prob_bin") == label, value)), F.lit(0)).alias(name)
        for label, name in zip(BIN_LABELS, BIN_COLUMNS)
    ]
    binned = rows.where(F.col(index).isNotNull() & F.col("churn_prob_bin").isNotNull())
    totals = binned.rollup(index).agg(*cells, F.coalesce(F.sum(value), F.lit(0)).alias("grand_total"))
    totals = totals.withColumn(index, F.coalesce(index, F.lit(GRAND_TOTAL)))
    spine = rows.sparkSession.createDataFrame([(x,) for x in [*BIN_LABELS, GRAND_TOTAL]], f"{index} string")
    names = [*BIN_COLUMNS, "grand_total"]
    return spine.join(totals, index, "left").select(index, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def priority_pivot(priority: DataFrame) -> DataFrame:
    return _pivot(priority, "priority_bin", F.lit(1))


def revenue_pivot(priority: DataFrame) -> DataFrame:
    pivot = _pivot(priority, "revenue_bin", F.col("last_52_weeks_revenue_x"))
    return pivot.select("revenue_bin", *[F.round(n, SUM_DECIMALS).alias(n) for n in [*BIN_COLUMNS, "grand_total"]])


def with_parent_priority(combined: DataFrame, priority: DataFrame) -> DataFrame:
    """Parent priority on every account row; parents without priority drop out."""
    columns = ["priority", "churn_prob_bin", "priority_bin", "revenue_bin", "parent_rank"]
    return combined.join(priority.select(F.col("parentname").alias("parentname_x"), *columns), "parentname_x")


def account_ranks(accounts: DataFrame) -> DataFrame:
    """Rank accounts of parents that have several, by phone, recency, decline and cases."""
    sizes = accounts.groupBy("parentname_x").agg(F.count("*").alias("_accounts"))
    several = accounts.join(sizes.where("_accounts > 1").drop("_accounts"), "parentname_x", "left_semi")
    decline = F.expr(
        "CASE WHEN last_26_weeks_gallons <> 0"
        " THEN (last_26_weeks_gallons - last_4_weeks_gallons) / nullif(last_26_weeks_gallons, 0) * 100"
        " WHEN last_4_weeks_gallons > 0 THEN double('-infinity') WHEN last_4_weeks_gallons < 0 THEN double('infinity') END"
    )
    ranked = several.select(
        "parentname_x", "acctcode", "last_transaction_week", "count_sf_cases_last3m",
        F.when(F.col("phone").isNotNull(), 1).otherwise(2).alias("valid_phone"),
        decline.alias("decline_pct"),
        "last_52_weeks_revenue_y", "last_52_weeks_gallons_y",
    )
    ranked = stage(ranked, "accounts")
    ranks = dense_ranks(ranked, "acctcode", "parentname_x", RANK_NAMES)
    used = ["valid_phone", "rank_last_transaction_week", "rank_decline", "rank_sf_cases"]
    mean = "(" + " + ".join(f"coalesce({c}, 0)" for c in used) + ") / 4 AS global_rank_mean"
    both = stage(ranked.join(ranks, "acctcode", "left").selectExpr("*", mean), "ranks")
    final = dense_ranks(both, "acctcode", "parentname_x", {"global_rank_mean": "account_rank"}, descending=False)
    return both.join(final, "acctcode")


def account_priority(combined: DataFrame, priority: DataFrame) -> DataFrame:
    """Account rank next to the parent's priority; single accounts rank first."""
    accounts = with_parent_priority(combined, priority)
    ranks = account_ranks(accounts).select("acctcode", "account_rank")
    joined = accounts.join(ranks, "acctcode", "left")
    joined = joined.withColumn("account_rank", F.coalesce("account_rank", F.lit(1)).cast("long"))
    return joined.withColumnsRenamed(level_names(joined.columns))


def level_names(columns: list[str]) -> dict[str, str]:
    """``_x`` and ``_y`` become parent and account level; two names just lose ``_x``."""
    plain = {"parentname_x": "parentname", "churn_prob_x": "churn_prob"}
    suffixes = {"_x": "_parent_level", "_y": "_account_level"}
    renamed = {}
    for c in columns:
        if c in plain:
            renamed[c] = plain[c]
        elif c[-2:] in suffixes:
            renamed[c] = c[:-2] + suffixes[c[-2:]]
    return renamed
