"""One named query per operator, over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions import labels
from ebbtide.functions import weeks as wk
from ebbtide.functions.order_stats import quartile_scores
from ebbtide.functions.staging import new_path, stage
from ebbtide.modelling import evaluate, explain, prepare, select, train
from ebbtide.operators import behaviour, checks, contact, fact, feature_table, priority, profile, ranges, rollup
from ebbtide.operators import calendar as cal
from ebbtide.plans import bundle, flagship
from ebbtide.plans.inputs import Inputs
from ebbtide.session import configure
from ebbtide.sources import logical, sinks
from ebbtide.sources.tables import read_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register under the function's name."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        return function(Inputs(configure(spark), root))

    QUERIES[function.__name__] = run
    return function


def nullable_counts(df: DataFrame) -> DataFrame:
    """Counts that can be missing as doubles, which every client reads alike."""
    return df.selectExpr(*[
        f"CAST({c} AS DOUBLE) AS {c}" if c in fact.COUNT_MEASURES else c for c in df.columns
    ])


# ------------------------------------------------------- calendar and periods

@query
def calendar_lookup(i: Inputs) -> DataFrame:
    orders = i.tables.orders.select(F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    daily = orders.groupBy("day").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 6).alias("spend"))
    return cal.with_week(daily, F.col("day"), i.calendar, "left", {"week_no": "week", "fm_month": "month"})


@query
def run_params(i: Inputs) -> DataFrame:
    row = cal.latest_common_week(logical.platform_days(i.tables), i.calendar)
    return row.withColumns({
        "recency_cutoff_week": wk.week_minus(F.col("current_week"), i.p.recency_weeks),
        "activity_floor": wk.week_minus(F.col("current_week"), i.p.activity_weeks),
        "history_floor": wk.week_minus(F.col("current_week"), i.p.history_weeks),
    })


@query
def week_math(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    key = wk.week_key(day)
    days = i.tables.orders.select(day.alias("day"), key.alias("week")).distinct()
    return days.select(
        "day", "week",
        wk.week_first_day(F.col("week")).alias("first_day"),
        wk.week_minus(F.col("week"), 2).alias("minus_2"),
        wk.week_minus(F.col("week"), 104).alias("minus_104"),
        wk.iso_week_key(F.date_sub("day", 34 * 7)).alias("train_week"),
        wk.iso_week_key(F.date_sub("day", 26 * 7)).alias("holdout_week"),
        wk.month_minus(wk.month_key(F.col("day")), 12).alias("month_minus_12"),
    )


@query
def string_keys(i: Inputs) -> DataFrame:
    """Accounts of ledger rows with either date in the history window, whatever kind of fee they are."""
    rows = logical.ledger(i.tables)
    either = logical.within_days("tran_date", i.p.history_days) | logical.within_days("load_date", i.p.history_days)
    rows = rows.where(either).select("account_no").distinct()
    width = logical.ACCOUNT_WIDTH
    return rows.select(
        "account_no",
        F.right(F.trim("account_no"), F.lit(width)).alias("code"),
        F.right("account_no", F.lit(width)).cast("long").alias("customer_id"),
        F.substring("account_no", 10, 5).alias("middle"),
        F.left("account_no", F.lit(2)).alias("prefix"),
        F.lpad(F.substring("account_no", 12, 4), 6, "0").alias("padded"),
    )


# ------------------------------------------------------------- accounts, fact

@query
def active_accounts(i: Inputs) -> DataFrame:
    return i.active


@query
def weekly_spine(i: Inputs) -> DataFrame:
    return fact.weekly_spine(i.active, i.p)


@query
def trx_platform_a(i: Inputs) -> DataFrame:
    return fact.trx_platform_a(i.transactions, i.accounts, i.history_calendar).withColumn("total_discount", F.round("total_discount", 6))


@query
def trx_platform_b(i: Inputs) -> DataFrame:
    return fact.trx_platform_b(i.transactions, i.accounts, i.history_calendar).withColumn("total_discount", F.round("total_discount", 6))


@query
def fuel_stats(i: Inputs) -> DataFrame:
    return fact.fuel_stats(i.transactions, i.accounts, i.history_calendar)


@query
def channel_spend_weekly(i: Inputs) -> DataFrame:
    return fact.channel_spend_weekly(i.transactions, i.active, i.history_calendar)


@query
def platform_fee_weekly(i: Inputs) -> DataFrame:
    return fact.platform_fee_weekly(i.transactions, i.active, i.history_calendar)


@query
def fee_ledger_weekly(i: Inputs) -> DataFrame:
    return nullable_counts(fact.fee_ledger_weekly(i.ledger, i.products, i.active, i.history_calendar, logical.ACCOUNT_WIDTH))


@query
def fee_equipment(i: Inputs) -> DataFrame:
    return fact.fee_equipment(i.ledger, i.products, i.active, i.history_calendar, logical.ACCOUNT_WIDTH)


@query
def settlement_fee_weekly(i: Inputs) -> DataFrame:
    return fact.settlement_fee_weekly(i.settlements, i.active, i.history_calendar)


@query
def weekly_fact(i: Inputs) -> DataFrame:
    return nullable_counts(i.weekly_fact)


@query
def rollup_weekly(i: Inputs) -> DataFrame:
    return i.parent_weekly


# -------------------------------------------------------------- labelled weeks

@query
def active_parents(i: Inputs) -> DataFrame:
    return ranges.active_parents(i.parent_weekly, i.p.min_weeks)


@query
def orphan_parents(i: Inputs) -> DataFrame:
    return rollup.orphan_parents(i.accounts.where("parentname IS NOT NULL"), ranges.active_parents(i.parent_weekly, i.p.min_weeks))


@query
def lifetime_bounds(i: Inputs) -> DataFrame:
    trimmed = ranges.lifetime_bounds(i.parent_weekly, i.p.min_weeks)
    return trimmed.select("parentname", "week", "min_lifetime_week", "max_lifetime_week")


LABELS = ["parentname", "week", "week_rank", *[f"week_range_{n}" for n in (4, 8, 13, 26, 52)]]


@query
def week_ranges(i: Inputs) -> DataFrame:
    return ranges.labelled_weeks(i.parent_weekly, i.p).select(LABELS)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, so that values compare across engines."""
    return df.select([
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


@query
def random_cutoff(i: Inputs) -> DataFrame:
    trimmed = ranges.lifetime_bounds(i.parent_weekly, i.p.min_weeks)
    last = trimmed.groupBy("parentname").agg(F.max("max_lifetime_week").alias("last"))
    status = last.select("parentname", rollup.churn_flag(F.col("last"), i.p).alias("churn_flag"))
    cut = ranges.random_cutoff(trimmed, status, i.p)
    return cut.groupBy("parentname").agg(F.count("*").alias("weeks"), F.max("week").alias("last_week"))


# --------------------------------------------------------------------- profile

@query
def last_activity(i: Inputs) -> DataFrame:
    return profile.last_activity(i.all_transactions, i.accounts, i.calendar, i.p)


@query
def latest_attribute(i: Inputs) -> DataFrame:
    return profile.latest_attribute(logical.billing_terms(i.tables), logical.deals(i.tables))


@query
def last_payment(i: Inputs) -> DataFrame:
    return profile.last_payment(logical.payments(i.tables))


@query
def product_top6(i: Inputs) -> DataFrame:
    return profile.product_top6(i.revenue, i.p)


@query
def product_spend(i: Inputs) -> DataFrame:
    return profile.product_spend(i.revenue, i.p)


@query
def account_profile(i: Inputs) -> DataFrame:
    return i.profile


@query
def rollup_profile(i: Inputs) -> DataFrame:
    return rollup.rollup_profile(i.profile, i.p)


@query
def channel_class(i: Inputs) -> DataFrame:
    attributes = profile.latest_attribute(logical.billing_terms(i.tables), logical.deals(i.tables))
    kept = attributes.select("customer_id", "channel_1", "channel_2")
    return kept.withColumn("channel", labels.channel_class(F.col("channel_1"), F.col("channel_2")))


@query
def credit_grade(i: Inputs) -> DataFrame:
    return i.accounts.select("customer_id", "credit_score", labels.credit_grade(F.col("credit_score")).alias("credit_grade"))


@query
def product_bucket(i: Inputs) -> DataFrame:
    top = profile.product_top6(i.revenue, i.p)
    combination = labels.product_combination([F.col(f"product_information_{n}") for n in range(1, 7)])
    return top.select("customer_id", combination.alias("combination")).withColumn("bucket", labels.product_bucket(F.col("combination")))


@query
def static_features_query(i: Inputs) -> DataFrame:
    return i.static


QUERIES["static_features"] = QUERIES.pop("static_features_query")


# -------------------------------------------------------------------- features

@query
def fee_types_count(i: Inputs) -> DataFrame:
    counted = behaviour.fee_types_count(i.parent_weekly)
    return counted.select("parentname", "week", "unique_types_of_fees_applied", "unique_types_of_fees_refunded")


@query
def quartile_score(i: Inputs) -> DataFrame:
    averages = behaviour.transaction_averages(i.labelled)
    names = [f"{m}_avg" for m in behaviour.TRANSACTION_MEASURES]
    scored = quartile_scores(averages, "parentname", names)
    return scored.select("parentname", *[f"{m}_score" for m in behaviour.TRANSACTION_MEASURES])


@query
def pct_change(i: Inputs) -> DataFrame:
    averages = behaviour.transaction_averages(i.labelled)
    changed = behaviour.pct_change(averages, behaviour.TRANSACTION_MEASURES)
    return rounded(changed.select("parentname", *[c for c in (f"`{n}`" for n in changed.columns) if "_ch_" in c]))


@query
def transaction_features(i: Inputs) -> DataFrame:
    return rounded(behaviour.transaction_features(i.labelled))


@query
def fee_features(i: Inputs) -> DataFrame:
    return rounded(behaviour.fee_features(i.labelled))


@query
def fee_flags(i: Inputs) -> DataFrame:
    return rounded(behaviour.fee_flags(i.labelled))


@query
def call_type_clean(i: Inputs) -> DataFrame:
    kind, subtype = labels.call_type(F.col("type"), F.col("subtype"))
    cases = logical.cases(i.tables).select("type", "subtype", kind.alias("grouped_type"), subtype.alias("clean_subtype"))
    return cases.groupBy("type", "subtype", "grouped_type", "clean_subtype").agg(F.count("*").alias("cases"))


@query
def call_cases(i: Inputs) -> DataFrame:
    return i.call_cases.select("customer_id", "parentname", "call_week", "type", "subtype", "status_changes", "created_date")


@query
def dedup_cases(i: Inputs) -> DataFrame:
    cases = logical.cases(i.tables).select("type", "subtype", "status_changes", "created_date")
    return contact.dedup_cases(cases)


@query
def call_weekly(i: Inputs) -> DataFrame:
    return contact.call_weekly(i.call_cases)


@query
def call_features(i: Inputs) -> DataFrame:
    return rounded(contact.call_features(i.labelled, contact.call_weekly(i.call_cases)))


@query
def survey_responses(i: Inputs) -> DataFrame:
    return i.survey_responses


@query
def survey_weekly(i: Inputs) -> DataFrame:
    return rounded(contact.survey_weekly(i.survey_responses))


@query
def survey_features(i: Inputs) -> DataFrame:
    return rounded(contact.survey_features(i.labelled, i.survey_responses))


@query
def full_outer_features(i: Inputs) -> DataFrame:
    weekly_calls = contact.call_weekly(i.call_cases).groupBy("parentname").agg(F.sum("statuschangeflag_count").alias("cases"))
    answers = contact.survey_counts(i.survey_responses).groupBy("parentname").agg(F.sum("responses").alias("responses"))
    fees = i.parent_weekly.groupBy("parentname").agg(F.round(F.sum("tot_fee_amount"), 6).alias("fees"))
    return feature_table.full_outer_features([weekly_calls, answers, fees])


@query
def feature_table_query(i: Inputs) -> DataFrame:
    return rounded(feature_table.feature_table(i.families, i.p))


QUERIES["feature_table"] = QUERIES.pop("feature_table_query")


@query
def stage_invariants(i: Inputs) -> DataFrame:
    labelled, parent_profile = i.labelled, i.parent_profile
    return checks.stage_invariants([
        checks.not_empty(labelled, "labelled weeks present"),
        checks.one_row_per(parent_profile, "parentname", "profile has one row per parent"),
        checks.one_row_per(behaviour.fee_flags(labelled), "parentname", "fee flags have one row per parent"),
        checks.one_row_per(i.accounts, "customer_id", "accounts have one row each"),
        checks.no_orphans(labelled, parent_profile, "parentname", "labelled parents have a profile"),
    ])


# -------------------------------------------------------------------- priority

@query
def parent_pct_rank(i: Inputs) -> DataFrame:
    return rounded(priority.parent_pct_rank(priority.parent_frame(i.combined)))


@query
def parent_priority(i: Inputs) -> DataFrame:
    columns = ["parentname", "priority", "churn_prob_bin", "priority_bin", "revenue_bin", "parent_rank"]
    return rounded(priority.parent_priority(i.combined).select(columns))


@query
def priority_pivot(i: Inputs) -> DataFrame:
    return priority.priority_pivot(i.priority)


@query
def revenue_pivot(i: Inputs) -> DataFrame:
    return priority.revenue_pivot(i.priority)


@query
def account_priority(i: Inputs) -> DataFrame:
    return rounded(priority.account_priority(i.combined, i.priority))


# ------------------------------------------------------------------- modelling

def model_frame(i: Inputs) -> tuple[DataFrame, list[str]]:
    """Every numeric feature with the label, and the names of the features in order."""
    features = i.features
    columns = sorted(c for c in features.columns if c not in prepare.NOT_FEATURES and c not in prepare.CATEGORIES)
    numeric = [prepare.q(c).cast("double").alias(c) for c in columns]
    return stage(features.select("parentname", "churn_flag", *numeric), "model"), columns


def fixed_weights(columns: list[str]) -> dict[str, float]:
    """Weights that SQL can repeat, in place of a fitted model's."""
    return {c: round((-1) ** k * (0.9 - 0.05 * (k % 18)), 2) for k, c in enumerate(columns)}


def long_rounded(frame: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    long = prepare.long_form(frame, columns, ["parentname"]).where(F.col("value").isNotNull())
    return long.withColumn("value", F.round("value", places))


@query
def one_hot_align(i: Inputs) -> DataFrame:
    hot = prepare.one_hot(i.static.select("parentname", *prepare.CATEGORIES))
    columns = [f"{c}_{v}" for c, values in prepare.CATEGORIES.items() for v in values] + ["state_code_ZZ"]
    return prepare.align(hot, columns)


@query
def power_transform(i: Inputs) -> DataFrame:
    frame, columns = model_frame(i)
    return long_rounded(prepare.power_transform(frame, columns), columns)


@query
def standard_scale(i: Inputs) -> DataFrame:
    frame, columns = model_frame(i)
    return long_rounded(prepare.standard_scale(frame, columns), columns)


@query
def constant_columns(i: Inputs) -> DataFrame:
    flags = behaviour.fee_flags(i.labelled)
    return prepare.constant_columns(flags, [c for c in flags.columns if c != "parentname"])


@query
def anova_f(i: Inputs) -> DataFrame:
    return select.anova_f(*model_frame(i))


@query
def mutual_info(i: Inputs) -> DataFrame:
    return select.mutual_info(*model_frame(i))


@query
def feature_votes(i: Inputs) -> DataFrame:
    frame, columns = model_frame(i)
    by_f, by_mi = select.anova_f(frame, columns), select.mutual_info(frame, columns)
    scores = stage(by_f.join(by_mi, "measure", "full_outer"), "scores")
    place_f = F.row_number().over(Window.orderBy(F.desc_nulls_last("f"), "measure"))
    place_mi = F.row_number().over(Window.orderBy(F.desc_nulls_last("mi"), "measure"))
    placed = scores.select("measure", place_f.alias("pf"), place_mi.alias("pm"))
    limits = {v: (("pf", "pm")[k % 2], 3 + k) for k, v in enumerate(select.VOTES)}
    return select.feature_votes(placed.select("measure", *[(F.col(c) <= n).alias(v) for v, (c, n) in limits.items()]))


@query
def score_bands(i: Inputs) -> DataFrame:
    return i.scored.select("parentname", "churn_prob", "churn_rank", "churn_flag_predicted")


@query
def score_distribution(i: Inputs) -> DataFrame:
    return evaluate.score_distribution(i.scored)


@query
def binary_metrics(i: Inputs) -> DataFrame:
    return evaluate.binary_metrics(i.scored, by=["customer_size"])


@query
def precision_at_n(i: Inputs) -> DataFrame:
    return evaluate.precision_at_n(i.scored, 25)


@query
def validation_table(i: Inputs) -> DataFrame:
    probability = logical.churn_probability(F.col("parentname"))
    profiles = i.parent_profile.select("parentname", "last_transaction_week", "churn_flag", probability.alias("churn_prob"))
    churned = evaluate.score_bands(profiles.where("churn_flag = 'CHURNER'"))
    return evaluate.validation_table(churned, evaluate.validation_bounds(i.p.activity_floor))


@query
def score_factors(i: Inputs) -> DataFrame:
    frame, columns = model_frame(i)
    scaled = prepare.standard_scale(frame.select("*", explain.raw_values(columns)), columns)
    return explain.score_factors(scaled, explain.linear_attributions(fixed_weights(columns)), explain.raw_of(columns))


def fixed_forest(n: int, trees: int = 100, depth: int = 3) -> list[tuple[float, list[dict]]]:
    """Whole trees over ``n`` features, made by a rule: places as in a heap, numbers that binary fractions hold."""
    inner, every = 2**depth - 1, 2 ** (depth + 1) - 1
    forest = []
    for t in range(trees):
        nodes = [{"id": k, "prediction": ((13 * t + 29 * k) % 41 - 20) / 64} for k in range(every)]
        for k in range(inner):
            nodes[k] |= {"left": 2 * k + 1, "right": 2 * k + 2, "feature": (7 * t + 5 * k) % n, "threshold": ((3 * t + 11 * k) % 9 - 4) / 4 + 0.1}
        forest.append((0.5, nodes))
    return forest


@query
def forest_factors(i: Inputs) -> DataFrame:
    """Factors of a forest of 100 trees: of the 25 largest attributions ten names that are not dropped, every seventh being dropped."""
    frame, columns = model_frame(i)
    columns = sorted(columns)
    scaled = prepare.standard_scale(frame, columns)
    attributions = explain.tree_attributions(fixed_forest(len(columns)), columns)
    return explain.run_factors(scaled, attributions, explain.raw_of(columns), dropped=columns[::7])


@query
def score_combine(i: Inputs) -> DataFrame:
    segments = [prepare.segment(i.scored, name) for name in prepare.SEGMENTS]
    combined = sinks.stamp(evaluate.score_combine(segments), i.p.current_week, i.p.last_day)
    return combined.select(
        "parentname", "customer_size", "churn_prob", "churn_rank", "churn_flag_predicted",
        F.col("churn_flag").alias("churn_flag_actual"), "run_week", "run_date",
    )


@query
def sink_slice(i: Inputs) -> DataFrame:
    """Write two slices, write one of them again, and read the table back."""
    path = new_path(i.spark, "result")
    base = i.scored.select("parentname", "churn_prob", "churn_rank", "churn_flag_predicted")
    earlier, oldest = wk.week_key_minus(i.p.current_week, 1), wk.week_key_minus(i.p.current_week, 2)
    empty = base.where("false")
    for week, rows in ((oldest, base), (earlier, base), (i.p.current_week, base), (i.p.current_week, base.where("churn_rank >= 5")), (oldest, empty)):
        sinks.replace_slice(rows, path, week, i.p.last_day)
    schema = f"{base._jdf.schema().toDDL()}, run_week string, run_date date"
    return i.spark.read.schema(schema).parquet(path)


@query
def sink_archive(i: Inputs) -> DataFrame:
    """Archive the features of two run dates, one of them twice, and read all copies back."""
    path = new_path(i.spark, "archive")
    base = i.scored.select("parentname", "churn_prob", "churn_rank")
    for day, rows in ((i.p.first_day, base), (i.p.last_day, base), (i.p.last_day, base.where("churn_rank < 5"))):
        sinks.write_archive(rows, path, day)
    return i.spark.read.schema(f"{base._jdf.schema().toDDL()}, run_date date").parquet(path)


@query
def sink_append(i: Inputs) -> DataFrame:
    """Append two runs to a table and read the sum back."""
    table = f"ebbtide_runs_{uuid.uuid4().hex}"
    base = sinks.stamp(i.scored.select("parentname", "churn_prob"), i.p.current_week, i.p.last_day)
    sinks.append_table(base, table)
    sinks.append_table(base.where("churn_prob >= 0.5"), table)
    rows = stage(i.spark.table(table), "appended")
    i.spark.sql(f"DROP TABLE {table}")
    return rows


@query
def sink_params(i: Inputs) -> DataFrame:
    """Run parameters through their JSON sidecar."""
    path = new_path(i.spark, "params")
    row = cal.latest_common_week(logical.platform_days(i.tables), i.calendar)
    sinks.write_params(row, path)
    return i.spark.read.schema(row.schema).json(path)


@query
def csv_round_trip(i: Inputs) -> DataFrame:
    """Scores written as CSV and read back in declared types."""
    path = new_path(i.spark, "csv")
    rows = i.scored.select("parentname", "customer_size", "churn_prob", "churn_rank")
    rows.write.option("header", True).csv(path)
    return read_csv(i.spark, path, rows.schema)


@query
def quality_gate(i: Inputs) -> DataFrame:
    """Fleet sizes whose F1 misses the floor."""
    metrics = evaluate.binary_metrics(i.scored, by=["customer_size"])
    return evaluate.below_quality(metrics.withColumnRenamed("customer_size", "segment"))


def _fixed_models(i: Inputs) -> dict[str, flagship.LinearModel]:
    columns = sorted(prepare.feature_columns(prepare.one_hot(i.features)))
    weights = {c: round(w * 0.02, 4) for c, w in fixed_weights(columns).items()}
    return {name: flagship.LinearModel(weights) for name in prepare.SEGMENTS}


def _run_result(i: Inputs, models: dict) -> DataFrame:
    result = flagship.score_run(i, models, i.p.last_day, new_path(i.spark, "result"))
    return result.select(
        "parentname", "customer_size", "state_code", "credit_limit", F.round(F.col("tenure").cast("double"), 2).alias("tenure"),
        F.round(F.col("churn_prob").cast("double"), 4).alias("churn_prob"), "churn_rank", "churn_flag_predicted", "churn_flag_actual",
        *[f"factor_{n}" for n in range(1, 11)], "run_week", F.col("run_date").cast("date").alias("run_date"),
    )


def _reloaded(i: Inputs, models: dict) -> dict:
    """The models as a later driver finds them: saved as bundles of the run week, then loaded."""
    path = new_path(i.spark, "models")
    for name in list(models):
        bundle.save_model(i.spark, models.pop(name), path, name, i.p.current_week)
    return {name: bundle.load_model(i.spark, path, name) for name in prepare.SEGMENTS}


@query
def score_run_result(i: Inputs) -> DataFrame:
    """A scoring run of all segments with fixed weights, written to the result table and read back."""
    return _run_result(i, _fixed_models(i))


@query
def score_loaded(i: Inputs) -> DataFrame:
    """The same run with models that were saved as bundles and loaded again."""
    return _run_result(i, _reloaded(i, _fixed_models(i)))


# Spark ML has no SQL counterpart: the queries below are checked for their rows only.

def _segment_matrix(i: Inputs, name: str) -> tuple[DataFrame, list[str]]:
    """One-hot features of a segment without constant columns, transformed and scaled, and the column names."""
    fitted, scaled = flagship.fit_preparation(i.features, name)
    return scaled, fitted.columns


def _best(hot: DataFrame, columns: list[str], k: int) -> list[str]:
    """The k columns of highest F value; a bounded list of names."""
    return [r.measure for r in select.top_k(select.anova_f(hot, columns), "f", k).collect()]


def _segments(of: Callable[[str], DataFrame], together: bool = False) -> DataFrame:
    """The rows of all segments below each other, with the segment's name; the segments run side by side if ``together``."""
    found = None
    for name, rows in zip(prepare.SEGMENTS, _in_order(of) if together else map(of, prepare.SEGMENTS)):
        rows = rows.withColumn("segment", F.lit(name))
        found = rows if found is None else found.unionByName(rows)
    return found


def _in_order(of: Callable[[str], DataFrame]) -> list[DataFrame]:
    """``of`` for all segments side by side, begun one after the other."""
    begun = [Event() for _ in range(len(prepare.SEGMENTS) + 1)]
    begun[0].set()

    def one(k: int, name: str) -> DataFrame:
        begun[k].wait()
        begun[k + 1].set()
        return of(name)

    return train.side_by_side([lambda k=k, name=name: one(k, name) for k, name in enumerate(prepare.SEGMENTS)])


@query
def model_select(i: Inputs) -> DataFrame:
    return _segments(lambda name: train.model_select(*_segment_matrix(i, name)))


@query
def rfe(i: Inputs) -> DataFrame:
    return _segments(lambda name: train.rfe(*_segment_matrix(i, name)))


@query
def model_leaderboard(i: Inputs) -> DataFrame:
    """Five models on the twelve sets of nine votes, by the training run of each segment."""
    extracts = flagship.TrainingExtracts(i.spark, i.tables.root)
    return _segments(lambda name: flagship.train_run(i.spark, extracts, name)[0].board, together=True)


@query
def tune(i: Inputs) -> DataFrame:
    """The grids of the best three of the comparison, by the training run of each segment."""
    extracts = flagship.TrainingExtracts(i.spark, i.tables.root)
    return _segments(lambda name: flagship.train_run(i.spark, extracts, name)[0].tuned, together=True)


@query
def train_segment(i: Inputs) -> DataFrame:
    rows = []
    for name in prepare.SEGMENTS:
        scaled, columns = _segment_matrix(i, name)
        best = _best(scaled, columns, select.KEPT_FEATURES)
        weights = train.coefficients(train.train_segment(scaled, best), best)
        rows += [(name, c, w) for c, w in weights.items()]
    return i.spark.createDataFrame(rows, "segment string, feature string, weight double")


@query
def score_segment(i: Inputs) -> DataFrame:
    """Fit a model of each segment, save and load it, and apply what was loaded, with factors."""
    models = _reloaded(i, {name: flagship.train_model(i.features, name) for name in prepare.SEGMENTS})
    result = flagship.score_run(i, models, i.p.last_day, new_path(i.spark, "result"))
    return result.select("parentname", "customer_size", "churn_prob", "churn_rank", "churn_flag_predicted", *[f"factor_{n}" for n in range(1, 11)])
