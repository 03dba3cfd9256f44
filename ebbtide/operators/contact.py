"""Support cases and survey responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import labels
from ebbtide.functions.ratios import ratio_or_zero
from ebbtide.operators.behaviour import aggregate, count_where, extend, in_range
from ebbtide.operators.calendar import with_week

SPANS = [52, 26, 8]
CALL_COLUMNS = {t: t.lower().replace(" ", "_") for t in [*labels.CALL_TYPES_KEPT, "Others"]}
# Close inquiries and others are counted weekly but give no feature.
CALL_FEATURE_TYPES = [t.replace(" ", "_") for t in labels.CALL_TYPES_KEPT if t != "close inquiry"]
STATUS_CHANGES = 3
SOLVED = "Absolutely"

SURVEY_COUNTS = [
    "productrating_cnt", "agentrating_cnt", "product_promoter_cnt", "product_detractor_cnt",
    "agent_promoter_cnt", "agent_detractor_cnt",
]


def _of_accounts(rows: DataFrame, contacts: DataFrame, parents: DataFrame) -> DataFrame:
    """Events joined over distinct contacts to active accounts with a parent.

    The account sides are joined first, so the event rows, of which one account
    may hold very many, are shuffled for a single join.
    """
    refs = contacts.select("account_ref", "customer_id").distinct().join(parents, "customer_id")
    return rows.join(refs, "account_ref").drop("account_ref")


def dedup_cases(rows: DataFrame) -> DataFrame:
    """Equal rows once."""
    return rows.dropDuplicates()


def call_cases(cases: DataFrame, contacts: DataFrame, parents: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cases of active accounts with parent and week, equal rows once.

    ``parents`` holds (customer_id, parentname) of active accounts.
    """
    dated = with_week(cases, F.col("created_date"), calendar, "inner", {"week_no": "call_week"})
    return dedup_cases(_of_accounts(dated, contacts, parents))


def call_weekly(cases: DataFrame) -> DataFrame:
    """Counts per grouped call type and of status changes per (parent, week)."""
    grouped, _ = labels.call_type(F.col("type"), F.col("subtype"))
    typed = cases.select(
        "parentname", "call_week", grouped.alias("type"),
        F.coalesce((F.col("status_changes") >= STATUS_CHANGES).cast("int"), F.lit(0)).alias("flag"),
    )
    counts = {
        "statuschangeflag_count": "count(*)",
        "statuschangeflag_sum": "sum(flag)",
        **{column: f"count_if(type = '{t}')" for t, column in CALL_COLUMNS.items()},
    }
    return typed.groupBy("parentname", "call_week").agg(*[F.expr(f"{text} AS {name}") for name, text in counts.items()])


def call_features(labelled: DataFrame, weekly_calls: DataFrame) -> DataFrame:
    """21 columns per parent."""
    weeks = labelled.select("parentname", "week", *[f"week_range_{n}" for n in SPANS])
    calls = weekly_calls.withColumnRenamed("call_week", "week")
    joined = weeks.join(calls, ["parentname", "week"], "left")
    sums = {}
    for t in CALL_FEATURE_TYPES:
        for n in (52, 8):
            sums[f"s_{t}_{n}"] = f"sum({t}) FILTER (WHERE {in_range(n)})"
            sums[f"n_{t}_{n}"] = count_where(f"{in_range(n)} AND {t} <> 0")
    for n in SPANS:
        sums[f"flags_{n}"] = f"sum(statuschangeflag_sum) FILTER (WHERE {in_range(n)})"
        sums[f"cases_{n}"] = f"sum(statuschangeflag_count) FILTER (WHERE {in_range(n)})"
    summed = aggregate(joined, sums)
    columns = {f"freq_{t}_{n}": ratio_or_zero(f"s_{t}_{n}", f"n_{t}_{n}") for t in CALL_FEATURE_TYPES for n in (52, 8)}
    columns |= {f"status_change_lt3_ratio_{n}": ratio_or_zero(f"flags_{n}", f"cases_{n}") for n in SPANS}
    ratios = summed.selectExpr("parentname", *[f"{text} AS {name}" for name, text in columns.items()])
    return extend(ratios, {
        f"status_change_lt3_ch_1-52_1-{n}": f"status_change_lt3_ratio_52 - status_change_lt3_ratio_{n}" for n in (8, 26)
    })


def survey_responses(
    surveys: DataFrame, contacts: DataFrame, parents: DataFrame, calendar: DataFrame, floor_week: int = 0
) -> DataFrame:
    """Responses of active accounts, dated by response or else creation, equal rows once."""
    dated = surveys.withColumn("case_response_dt", F.coalesce("response_date", "created_date")).drop("response_date", "created_date")
    dated = with_week(dated, F.col("case_response_dt"), calendar, "inner", {"week_no": "case_week"})
    dated = dated.where(F.col("case_week") >= floor_week)
    return dedup_cases(_of_accounts(dated, contacts, parents)).select(
        "customer_id", "parentname", "issue_solved", "product_rating", "agent_rating",
        "product_nps", "agent_nps", "case_response_dt", "case_week",
    )


def _survey_counts() -> dict[str, str]:
    """Per (parent, week): responses, solved, ratings above zero, promoters, detractors."""
    return {
        "responses": "count(*)",
        "solved": f"count_if(issue_solved = '{SOLVED}')",
        "product_rated": "count_if(product_rating > 0)",
        "product_rating_sum": "sum(product_rating) FILTER (WHERE product_rating > 0)",
        "agent_rated": "count_if(agent_rating > 0)",
        "agent_rating_sum": "sum(agent_rating) FILTER (WHERE agent_rating > 0)",
        # Counts agent ratings on rows with a product rating above zero.
        "agent_rated_with_product": "count(agent_rating) FILTER (WHERE product_rating > 0)",
        "product_promoters": "count_if(product_nps = 'Promoter')",
        "product_detractors": "count_if(product_nps = 'Detractor')",
        "agent_promoters": "count_if(agent_nps = 'Promoter')",
        "agent_detractors": "count_if(agent_nps = 'Detractor')",
    }


def survey_counts(responses: DataFrame) -> DataFrame:
    return responses.groupBy("parentname", "case_week").agg(*[F.expr(f"{t} AS {n}") for n, t in _survey_counts().items()])


def survey_weekly(responses: DataFrame) -> DataFrame:
    """Week statistics repeated on each response; zero on rows a statistic is not about."""
    def where(condition: str, value: str, empty: str = "0") -> str:
        return f"CASE WHEN {condition} THEN {value} ELSE {empty} END"

    joined = responses.join(survey_counts(responses), ["parentname", "case_week"])
    solved = f"CAST(coalesce(issue_solved = '{SOLVED}', false) AS INT)"
    return extend(joined, {
        "issuesolvedflag": solved,
        "issuesolved_all_count": "responses",
        "issuesolved_solved_count": "solved",
        "avg_product_rating": where("product_rating > 0", ratio_or_zero("product_rating_sum", "product_rated"), "0D"),
        "avg_agent_rating": where("agent_rating > 0", ratio_or_zero("agent_rating_sum", "agent_rated"), "0D"),
        "productrating_cnt": where("product_rating > 0", "product_rated"),
        "agentrating_cnt": where("product_rating > 0", "agent_rated_with_product"),
        "product_promoter_cnt": where("product_nps = 'Promoter'", "product_promoters"),
        "product_detractor_cnt": where("product_nps = 'Detractor'", "product_detractors"),
        "agent_promoter_cnt": where("agent_nps = 'Promoter'", "agent_promoters"),
        "agent_detractor_cnt": where("agent_nps = 'Detractor'", "agent_detractors"),
        "total_counts": "responses",
    }).drop(*_survey_counts())


def survey_features(labelled: DataFrame, responses: DataFrame, row_weighted: bool = True) -> DataFrame:
    """45 columns per parent."""
    return survey_features_of(labelled, survey_counts(responses), row_weighted)


def survey_features_of(labelled: DataFrame, counts: DataFrame, row_weighted: bool = True) -> DataFrame:
    """45 columns per parent, from ``survey_counts``.

    By default a week weighs as many times as it has responses: each statistic
    sits on the rows it is about, so the sum over a week is statistic times
    rows. ``row_weighted=False`` counts each week's rows once.
    """
    def weighted(value: str, rows: str) -> str:
        return f"{value} * {rows}" if row_weighted else value

    values = {
        "productrating_cnt": weighted("product_rated", "product_rated"),
        "agentrating_cnt": weighted("agent_rated_with_product", "product_rated"),
        "product_promoter_cnt": weighted("product_promoters", "product_promoters"),
        "product_detractor_cnt": weighted("product_detractors", "product_detractors"),
        "agent_promoter_cnt": weighted("agent_promoters", "agent_promoters"),
        "agent_detractor_cnt": weighted("agent_detractors", "agent_detractors"),
        "issue_solved": weighted("solved", "responses"),
        "total_counts": weighted("responses", "responses"),
    }
    kept = ["product_rating_sum", "product_rated", "agent_rating_sum", "agent_rated"]
    weekly = counts.selectExpr("parentname", "case_week AS week", *kept, *[f"{t} AS {n}" for n, t in values.items()])
    weeks = labelled.select("parentname", "week", *[f"week_range_{n}" for n in SPANS])
    joined = weeks.join(weekly, ["parentname", "week"], "left")
    sums = {f"s_{c}_{n}": f"sum({c}) FILTER (WHERE {in_range(n)})" for c in [*kept, *values] for n in SPANS}
    summed = aggregate(joined, sums)
    columns = {
        f"{who}_rating_avg_{n}": ratio_or_zero(f"s_{who}_rating_sum_{n}", f"s_{who}_rated_{n}") for who in ("product", "agent") for n in SPANS
    }
    for c in [*SURVEY_COUNTS, "issue_solved"]:
        columns |= {f"{c}_ratio_{n}": ratio_or_zero(f"s_{c}_{n}", f"s_total_counts_{n}") for n in SPANS}
    ratios = summed.selectExpr("parentname", *[f"{text} AS {name}" for name, text in columns.items()])
    changes = {
        f"{c}_ch_1-52_1-{n}": f"{c}_ratio_52 - {c}_ratio_{n}" for c in [*SURVEY_COUNTS, "issue_solved"] for n in (26, 8)
    }
    changes |= {
        f"{who}_rating_avg_ch_1-52_1-{n}": f"{who}_rating_avg_52 - {who}_rating_avg_{n}" for who in ("product", "agent") for n in (26, 8)
    }
    return extend(ratios, changes)
