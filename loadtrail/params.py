"""Parameters of one report run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame

from loadtrail import constants as c


@dataclass(frozen=True)
class ReportParams:
    """Shipper, workflow and the inclusive day range; `trigger_action` narrows the trigger rows."""

    shipper_id: str
    workflow: str
    start: date
    end: date
    trigger_action: str | None = None
    # how many trigger-response pairs and how many rows of one load a single task may get
    pairs_per_split: int = 4_000_000
    rows_per_split: int = 1_000_000
    # `request_id, days, first_day, last_day`: limits the history to open, if the log is laid out by day
    request_days: DataFrame | None = field(default=None, compare=False, repr=False)
    # the log holds rows of active requests only, and the grid of its hot loads is known (`operators.correlation.land_log`)
    rows_are_active: bool = False
    hot_loads: DataFrame | None = field(default=None, compare=False, repr=False)

    @classmethod
    def notifier(cls, shipper_id: str, start: str, end: str) -> ReportParams:
        return cls(shipper_id, c.NOTIFIER_WORKFLOW, date.fromisoformat(start), date.fromisoformat(end))

    @classmethod
    def ready_to_pickup(cls, shipper_id: str, start: str, end: str) -> ReportParams:
        return cls(
            shipper_id,
            c.READY_TO_PICKUP_WORKFLOW,
            date.fromisoformat(start),
            date.fromisoformat(end),
            c.SCAC_FETCHED_ACTION,
        )

    @property
    def day_after_end(self) -> date:
        return self.end + timedelta(days=1)

    def in_range(self, ts: str) -> str:
        """SQL condition for the half-open `[start, end + 1 day)`."""
        return (
            f"({ts} >= TIMESTAMP_NTZ'{self.start} 00:00:00' "
            f"AND {ts} < TIMESTAMP_NTZ'{self.day_after_end} 00:00:00')"
        )

    def logged_in_range(self, columns: Sequence[str]) -> str:
        """The same for `created_at`. A table laid out by `created_date` needs to open those days only."""
        if c.DAY_COLUMN in columns:
            days = f"{c.DAY_COLUMN} BETWEEN DATE'{self.start}' AND DATE'{self.end}'"
            return f"({days} AND {self.in_range('created_at')})"
        return self.in_range("created_at")

    def is_history_day(self, day: str) -> str:
        return f"({day} < DATE'{self.start}' OR {day} > DATE'{self.end}')"

    def logged_out_of_range(self, columns: Sequence[str]) -> str:
        if c.DAY_COLUMN in columns:
            # the range is made of whole days, so the day decides alone
            return self.is_history_day(c.DAY_COLUMN)
        return f"NOT {self.in_range('created_at')}"
