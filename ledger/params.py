"""Run parameters.

The reference reads ``current_date()`` and notebook widgets; here every such value is an
argument, so a run is reproducible and the month filter becomes a literal partition filter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    as_of: dt.date                      # "today": alert day, default report month
    cloud: str = "GCP"                  # one cloud per run (upper-cased like the reference)
    region: str = "us-central1"         # VM price region
    lookback_days: int | None = 90      # recompute window; None = whole history
    tz: str = "Asia/Kolkata"            # display zone for *_ist columns
    bounded: bool = True                # leave out usage after as_of (a run for a past day)

    def __post_init__(self):
        object.__setattr__(self, "cloud", self.cloud.upper())

    @property
    def window_start(self) -> dt.date | None:
        """Lower bound of the recompute window (inclusive), or None for all history."""
        if self.lookback_days is None:
            return None
        return self.as_of - dt.timedelta(days=self.lookback_days)

    @property
    def until(self) -> dt.date | None:
        """Last day of usage that the run takes in, or None for no upper bound."""
        return self.as_of if self.bounded else None
