"""Scores to bands, metrics and validation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.rounding import half_even
from ebbtide.functions.weeks import week_key_minus

QUALITY_FLOOR = 0.5
THRESHOLD = 0.5


def score_bands(scores: DataFrame, probability: str = "churn_prob") -> DataFrame:
    """Probability to four places half-even, decile rank and class.

    The class is the model's own where ``scores`` has it, else the unrounded probability
    against the threshold.
    """
    if "churn_flag_predicted" not in scores.columns:
        scores = scores.withColumn("churn_flag_predicted", (F.col(probability) >= THRESHOLD).cast("int"))
    rounded = half_even(F.col(probability), 4)
    return scores.withColumn(probability, rounded).withColumn(
        "churn_rank", F.floor(F.round(F.col(probability) * 10, 6)).cast("int")
    )


def score_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("churn_rank").agg(F.count("*").alias("parents"))


def _safe(num: Column, den: Column) -> Column:
    return F.coalesce(num / F.nullif(den, F.lit(0)), F.lit(0.0))


def binary_metrics(scored: DataFrame, actual: str = "churn_flag", predicted: str = "churn_flag_predicted", by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 from one confusion aggregation."""
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    counts = scored.groupBy(*(by or [])).agg(
        F.count(F.when(a & p, 1)).alias("tp"), F.count(F.when(~a & p, 1)).alias("fp"),
        F.count(F.when(a & ~p, 1)).alias("fn"), F.count(F.when(~a & ~p, 1)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": F.round(_safe(tp + tn, tp + fp + fn + tn), 6),
        "precision": F.round(_safe(tp, tp + fp), 6),
        "recall": F.round(_safe(tp, tp + fn), 6),
        "f1_score": F.round(_safe(2 * tp, 2 * tp + fp + fn), 6),
    })


def precision_at_n(scored: DataFrame, n: int, score: str = "churn_prob", actual: str = "churn_flag") -> DataFrame:
    """Share of positives in the n best scores, at best one."""
    positives = scored.agg(F.sum(actual).alias("positives"))
    best = scored.orderBy(F.desc(score), "parentname").limit(n).agg(F.sum(actual).alias("hits"))
    value = F.round(_safe(F.col("hits"), F.least(F.col("positives"), F.lit(n))), 6)
    return best.withColumn("positives", positives.scalar()).withColumn("precision_at_n", value)


# Weeks after the start week that close each bucket, and its text.
BUCKETS = [(4, "4 Weeks"), (8, "8 Weeks"), (13, "13 Weeks"), (23, "23 Weeks"), (33, "33 Weeks"), (53, "52 Weeks")]


def validation_bounds(start_week: int) -> list[tuple[str, str, int | None, int]]:
    """(label, weeks, low, high) with closed bounds; the first bucket is all before the start."""
    bounds = [(f"<{start_week}", "Past 8 Weeks", None, start_week - 1)]
    for weeks, text in BUCKETS:
        end = week_key_minus(start_week, -weeks)
        bounds.append((f"{start_week}-{end}", text, start_week, end))
    return bounds


def validation_table(churned: DataFrame, bounds: list[tuple[str, str, int | None, int]]) -> DataFrame:
    """Actual and predicted churners per overlapping bucket of the last week.

    All buckets are counted in one pass; ``churned`` holds churned parents only.
    """
    week = F.col("last_transaction_week")
    rows = []
    for label, weeks, low, high in bounds:
        inside = (week <= high) if low is None else week.between(low, high)
        rows.append(F.struct(
            F.lit(label).alias("last_transaction_weeks"), F.lit(weeks).alias("weeks"),
            F.count(F.when(inside, 1)).alias("actual_churners"),
            F.coalesce(F.sum(F.when(inside, F.col("churn_flag_predicted"))), F.lit(0)).alias("predicted_churners"),
        ))
    table = churned.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    percent = F.col("predicted_churners") / F.nullif(F.col("actual_churners"), F.lit(0)) * 100
    return table.withColumn("percentage_prediction", F.round(percent, 6))


def score_combine(segments: list[DataFrame]) -> DataFrame:
    """Segments on top of each other; medium counts as small, others as express check."""
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), segments)
    size = F.col("customer_size")
    recoded = F.when(size == "others", "express-check").when(size == "medium", "small").otherwise(size)
    return combined.withColumn("customer_size", recoded)


def below_quality(leaderboard: DataFrame, floor: float = QUALITY_FLOOR) -> DataFrame:
    """Segments whose best F1 misses the floor."""
    return leaderboard.groupBy("segment").agg(F.max("f1_score").alias("best_f1")).where(F.col("best_f1") < floor)
