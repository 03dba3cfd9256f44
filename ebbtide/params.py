"""Run parameters: one small record that turns into literals in every plan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from ebbtide.functions import weeks as wk


@dataclass(frozen=True)
class RunParams:
    """What a run is about.

    ``first_day`` and ``last_day`` bound the fiscal calendar, ``current_week``
    is the run week. Weeks are ``yyyyww`` integers throughout.
    """

    current_week: int
    first_day: dt.date
    last_day: dt.date
    activity_weeks: int = 52
    history_weeks: int = 104
    min_weeks: int = 13
    offset: int = 0
    seed: int = 0
    churn_weeks: int = 2
    recency_weeks: int = 9
    random_cutoff: bool = False

    @property
    def churn_cutoff_week(self) -> int:
        return wk.week_key_minus(self.current_week, self.churn_weeks)

    @property
    def recency_cutoff_week(self) -> int:
        return wk.week_key_minus(self.current_week, self.recency_weeks)

    @property
    def activity_floor(self) -> int:
        return wk.week_key_minus(self.current_week, self.activity_weeks)

    @property
    def history_floor(self) -> int:
        return wk.week_key_minus(self.current_week, self.history_weeks)

    @property
    def mondays(self) -> list[dt.date]:
        """Every calendar Monday; 52 entries a year."""
        first, last = wk.monday_of(self.first_day), wk.monday_of(self.last_day)
        return [first + dt.timedelta(days=7 * i) for i in range((last - first).days // 7 + 1)]

    def mondays_between(self, low: int, high: int) -> list[dt.date]:
        return [m for m in self.mondays if low <= wk.week_key_of(m) <= high]

    @property
    def history_mondays(self) -> list[dt.date]:
        return self.mondays_between(self.history_floor, self.current_week)

    @property
    def activity_mondays(self) -> list[dt.date]:
        return self.mondays_between(self.activity_floor, self.current_week)

    @property
    def current_month(self) -> int:
        monday = self.mondays_between(self.current_week, self.current_week)[0]
        return monday.year * 100 + monday.month

    @property
    def product_floor_month(self) -> int:
        return wk.month_key_minus(self.current_month, 12)

    def window_days(self, mondays: list[dt.date]) -> tuple[dt.date, dt.date]:
        """Half-open day range covered by the given Mondays."""
        return mondays[0], mondays[-1] + dt.timedelta(days=7)

    @property
    def history_days(self) -> tuple[dt.date, dt.date]:
        return self.window_days(self.history_mondays)

    @property
    def activity_days(self) -> tuple[dt.date, dt.date]:
        return self.window_days(self.activity_mondays)

    def for_training(self) -> "RunParams":
        """Training labels: eight weeks ahead, random cut-off for active parents."""
        return replace(self, offset=8, random_cutoff=True)


def as_of_week(today: dt.date, weeks_back: int) -> int:
    """ISO week key some weeks before today: 34 back to train, 26 to hold out."""
    return wk.iso_week_key_of(today - dt.timedelta(weeks=weeks_back))
