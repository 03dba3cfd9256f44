"""The logical inputs of one run, built on demand."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import weeks as wk
from ebbtide.functions.staging import stage, stage_bucketed
from ebbtide.modelling import evaluate
from ebbtide.operators import (
    behaviour, contact, fact, feature_table, metrics, priority, profile, ranges, rollup, static_features,
)
from ebbtide.operators import calendar as cal
from ebbtide.params import RunParams
from ebbtide.sources import logical
from ebbtide.sources.tables import Tables


class Inputs:
    """Logical inputs over the tables under ``root``, cut to the run's windows."""

    def __init__(self, spark: SparkSession, root: str, params: RunParams | None = None):
        self.spark = spark
        self.tables = Tables(spark, root)
        self._params = params

    @cached_property
    def p(self) -> RunParams:
        return self._params or logical.resolve_params(self.tables)

    @cached_property
    def calendar(self) -> DataFrame:
        return logical.calendar(self.tables, self.p)

    @cached_property
    def history_calendar(self) -> DataFrame:
        """Calendar of the history window: joining it is the week filter."""
        return self.calendar.where(self.calendar.week_no.between(self.p.history_floor, self.p.current_week))

    @cached_property
    def accounts(self) -> DataFrame:
        return logical.accounts(self.tables)

    @cached_property
    def transactions(self) -> DataFrame:
        return logical.transactions(self.tables, self.p.history_days)

    @cached_property
    def all_transactions(self) -> DataFrame:
        return logical.transactions(self.tables)

    @cached_property
    def recent_transactions(self) -> DataFrame:
        return logical.transactions(self.tables, self.p.activity_days)

    @cached_property
    def ledger(self) -> DataFrame:
        return logical.ledger(self.tables, self.p.history_days)

    @cached_property
    def products(self) -> DataFrame:
        return logical.products(self.tables)

    @cached_property
    def settlements(self) -> DataFrame:
        return logical.settlements(self.tables, self.p.history_days)

    @cached_property
    def active(self) -> DataFrame:
        recent = logical.activity(self.tables, self.p.activity_days)
        return stage(fact.active_accounts(recent, self.accounts, self.calendar, self.p), "active")

    @cached_property
    def active_parents(self) -> DataFrame:
        """(customer_id, parentname) of active accounts."""
        return self.accounts.where("parentname IS NOT NULL").select("customer_id", "parentname").join(
            self.active, "customer_id", "left_semi"
        )

    @cached_property
    def account_weeks(self) -> DataFrame:
        """Raw sums of active accounts per week, from one scan per kind of row; written once for all roll-ups."""
        t, days = self.tables, self.p.history_days
        rows = fact.source_rows(
            logical.transactions(t, days, self.active), logical.ledger(t, days, self.active), self.products,
            logical.settlements(t, days, self.active), self.history_calendar, logical.ACCOUNT_WIDTH,
        )
        return stage(fact.account_weeks(rows), "weeks")

    @cached_property
    def weekly_fact(self) -> DataFrame:
        return fact.weekly_fact(self.account_weeks, self.active, self.p)

    @cached_property
    def parent_weekly(self) -> DataFrame:
        return rollup.parent_weekly(self.account_weeks, self.active_parents, self.p)

    # ---- what the families read: written once, in buckets of parents, so families aggregate and join without an exchange

    @cached_property
    def labelled(self) -> DataFrame:
        status = self.parent_profile.select("parentname", "churn_flag") if self.p.random_cutoff else None
        return stage_bucketed(ranges.labelled_weeks(self.parent_weekly, self.p, status), "labelled", "parentname")

    @cached_property
    def revenue(self) -> DataFrame:
        low = wk.month_first_day_of(self.p.product_floor_month)
        return logical.monthly_revenue(self.tables, (low, self.p.last_day + dt.timedelta(days=1)))

    @cached_property
    def profile(self) -> DataFrame:
        # Open to later days than the run's: an account's last week may be one of them.
        low = min(self.p.activity_days[0], wk.month_first_day_of(self.p.product_floor_month))
        sold = profile.account_sales(logical.sales(self.tables, (low, dt.date.max)), self.accounts, self.calendar, self.p)
        attributes = profile.latest_attribute(logical.billing_terms(self.tables), logical.deals(self.tables))
        return profile.account_profile(
            sold, self.accounts, logical.first_months(self.tables), attributes, profile.last_payment(logical.payments(self.tables)), self.p
        )

    @cached_property
    def parent_profile(self) -> DataFrame:
        return stage_bucketed(rollup.rollup_profile(self.profile, self.p), "profile", "parentname")

    # ---- feature families

    @cached_property
    def static(self) -> DataFrame:
        return static_features.static_features(
            self.parent_profile, ranges.last_weeks(self.labelled), cal.month_of_week(self.calendar)
        )

    @cached_property
    def call_cases(self) -> DataFrame:
        t = self.tables
        return contact.call_cases(logical.cases(t), logical.contacts(t), self.active_parents, self.history_calendar)

    @cached_property
    def survey_responses(self) -> DataFrame:
        t = self.tables
        return contact.survey_responses(
            logical.surveys(t), logical.contacts(t), self.active_parents, self.history_calendar, self.p.history_floor
        )

    @cached_property
    def weekly_calls(self) -> DataFrame:
        return stage_bucketed(contact.call_weekly(self.call_cases), "calls", "parentname")

    @cached_property
    def weekly_surveys(self) -> DataFrame:
        return stage_bucketed(contact.survey_counts(self.survey_responses), "surveys", "parentname")

    @cached_property
    def families(self) -> list[DataFrame]:
        return [
            self.static,
            behaviour.transaction_features(self.labelled),
            behaviour.fee_features(self.labelled),
            behaviour.fee_flags(self.labelled),
            contact.call_features(self.labelled, self.weekly_calls),
            contact.survey_features_of(self.labelled, self.weekly_surveys),
        ]

    @cached_property
    def features(self) -> DataFrame:
        return stage(feature_table.feature_table(self.families, self.p), "features")

    # ---- prioritisation input

    @cached_property
    def combined(self) -> DataFrame:
        cases = contact.call_cases(
            logical.cases(self.tables), logical.contacts(self.tables), self.active_parents, self.history_calendar
        )
        rows = metrics.combined_metrics(self.recent_transactions, self.active_parents, self.accounts, cases, self.calendar, self.p)
        probability = logical.churn_probability(F.col("parentname_x"))
        return stage(rows.withColumn("churn_prob_x", probability), "combined")

    @cached_property
    def priority(self) -> DataFrame:
        return stage(priority.parent_priority(self.combined), "priority")

    @cached_property
    def scored(self) -> DataFrame:
        """Profile features with a fixed pseudo-score, for queries that need scores without a model."""
        probability = logical.churn_probability(F.col("parentname"))
        rows = feature_table.feature_table([self.static], self.p)
        return stage(evaluate.score_bands(rows.withColumn("churn_prob", probability)), "scored")
