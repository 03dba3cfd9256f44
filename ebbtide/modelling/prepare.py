"""Model matrix: indicators, alignment, power transform, scaling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import labels

# Categorical columns and every category they can hold.
CATEGORIES = {
    "state_code": [*labels.STATES, "OTHERS"],
    "num_of_trucks": [*labels.TRUCK_BANDS, "others"],
    "billing_freq": [*labels.BILLING_FREQUENCIES, "others"],
    "credit_grade": [*[g for _, g in labels.CREDIT_GRADES], "Excellent", "UNK"],
    "channel": ["inbound", "outbound", "field", "strategic/AM", "unknown", "others"],
    "product_type_most_frequent": [*labels.PRODUCT_BUCKETS, "OTHERS"],
}
# Columns that never enter a model.
NOT_FEATURES = [
    "parentname", "last_transaction_week", "last_transaction_month", "customer_size", "customer_segment",
    "first_trx_month", "churn_flag", "credit_limit", "last_payment_method",
]
SEGMENTS = {"small": ["small", "medium"], "large": ["large"], "express": ["others"]}
LAMBDA_GRID = [round(-2 + 0.25 * k, 2) for k in range(17)]


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def segment(features: DataFrame, name: str) -> DataFrame:
    """Parents of one fleet-size segment."""
    return features.where(F.col("customer_size").isin(SEGMENTS[name]))


def one_hot(features: DataFrame, categories: dict[str, list[str]] | None = None) -> DataFrame:
    """Replace categoricals by one 0/1 column per known category."""
    categories = categories or CATEGORIES
    kept = [q(c) for c in features.columns if c not in categories]
    indicators = [
        (F.col(c) == v).cast("double").alias(f"{c}_{v}") for c, values in categories.items() for v in values
    ]
    return features.select(*kept, *indicators)


def align(features: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("parentname",)) -> DataFrame:
    """Exactly the model's columns in its order; absent ones are 0.0."""
    present = set(features.columns)
    values = [(q(c).cast("double") if c in present else F.lit(0.0)).alias(c) for c in columns]
    return features.select(*[q(c) for c in keep], *values)


def long_form(features: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep…, measure, value): statistics of hundreds of columns become one grouped pass."""
    doubles = features.select(*[q(c) for c in keep], *[q(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([q(c) for c in keep], [q(c) for c in columns], "measure", "value")


def constant_columns(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with a single value."""
    spread = long_form(features, columns).groupBy("measure").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return spread.where("low = high").select("measure", F.col("low").alias("value"))


def scale_statistics(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, mean, sd): population standard deviation."""
    return long_form(features, columns).groupBy("measure").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    )


def by_place(statistics: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> Column:
    """A (measure, fields) table as one array of structs in the order of ``columns``, so a column's fit is found by its place.

    A column without statistics has null fields; a bounded value, one struct per column.
    """
    places = F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("place", "measure")
    named = statistics.sparkSession.range(1).select(places)
    entries = named.join(F.broadcast(statistics.select("measure", *fields)), "measure", "left")
    return entries.agg(F.array_sort(F.collect_list(F.struct("place", *fields)))).scalar()


def standard_scale(features: DataFrame, columns: Sequence[str], statistics: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; constant columns only lose their mean.

    Pass the training ``statistics`` at scoring time; by default the batch's own.
    """
    fitted = scale_statistics(features, columns) if statistics is None else statistics

    def scaled(value: Column, fit: Column) -> Column:
        return (value - fit["mean"]) / F.when(fit["sd"] == 0, 1.0).otherwise(fit["sd"])

    return _each_by_place(features, columns, by_place(fitted, columns, ["mean", "sd"]), scaled)


def _each_by_place(features: DataFrame, columns: Sequence[str], fits: Column, change: Callable[[Column, Column], Column]) -> DataFrame:
    """All ``columns`` changed by their fits in one expression over two arrays, whose code does not grow with the columns."""
    values = F.array(*[q(c).cast("double") for c in columns])
    others = [q(c) for c in features.columns if c not in set(columns)]
    both = features.select(*others, values.alias("_values"), fits.alias("_fits"))
    changed = both.select(*others, F.zip_with("_values", "_fits", change).alias("_changed"))
    return changed.select(*others, *[F.get("_changed", F.lit(place)).alias(c) for place, c in enumerate(columns)])


def yeo_johnson(value: Column, lam: Column) -> Column:
    up, down = F.lit(1.0) + value, F.lit(1.0) - value
    other = F.lit(2.0) - lam
    positive = F.when(lam == 0, F.log1p(value)).otherwise((F.pow(up, lam) - 1) / F.nullif(lam, F.lit(0.0)))
    negative = F.when(lam == 2, -F.log1p(-value)).otherwise(-(F.pow(down, other) - 1) / F.nullif(other, F.lit(0.0)))
    return F.when(value >= 0, positive).otherwise(negative)


def power_fit(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, lam): the grid value of highest likelihood per column.

    The likelihood needs only the count, the variance after transforming and
    the sum of signed logs, so all grid values are scored in one aggregation.
    """
    long = long_form(features, columns).where(F.col("value").isNotNull())
    variances = [F.var_pop(yeo_johnson(F.col("value"), F.lit(lam))) for lam in LAMBDA_GRID]
    stats = long.groupBy("measure").agg(
        F.count("*").alias("n"),
        F.sum(F.signum("value") * F.log1p(F.abs("value"))).alias("logs"),
        F.array(*variances).alias("variances"),
    )
    scored = stats.select(
        "measure", "n", "logs",
        F.inline(F.arrays_zip(F.array(*map(F.lit, LAMBDA_GRID)).alias("lam"), F.col("variances").alias("variance"))).alias("lam", "variance"),
    )
    likelihood = F.round(-F.col("n") / 2 * F.log(F.col("variance")) + (F.col("lam") - 1) * F.col("logs"), 6)
    scored = scored.withColumn("likelihood", F.when(F.col("variance") > 1e-12, likelihood))
    best = F.max_by("lam", F.struct("likelihood", F.negative("lam")))
    best = F.when(F.max("likelihood").isNull(), 1.0).otherwise(best)
    return scored.groupBy("measure").agg(best.alias("lam"), F.max("likelihood").alias("likelihood"))


def power_transform(features: DataFrame, columns: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """Yeo-Johnson transform; pass the training fit to reuse it at scoring time."""
    fit = power_fit(features, columns) if fitted is None else fitted
    return _each_by_place(features, columns, by_place(fit, columns, ["lam"]), lambda value, fit: yeo_johnson(value, fit["lam"]))


def feature_columns(features: DataFrame) -> list[str]:
    """Numeric feature columns of a one-hot frame."""
    return [c for c in features.columns if c not in NOT_FEATURES]
