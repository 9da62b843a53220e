"""Run parameters and the load window.

The source job chose between a full load and a 45-day lookback. Its date
predicates were broken as written (an unquoted date literal for one family, a
quoted arithmetic expression for the other); this module builds the intent:
``start = full_start`` on a full load, else ``as_of - lookback_days``, with
``as_of`` explicit so that a re-run is repeatable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the source job's:
#   lookback of the incremental load: 45 days
#   full-load start of the WT family: 2019-01-01
#   full-load start of the CW family: 2018-01-01
LOOKBACK_DAYS = 45
WT_FULL_START = dt.date(2019, 1, 1)
CW_FULL_START = dt.date(2018, 1, 1)


@dataclass(frozen=True)
class LoadWindow:
    """Inclusive lower bound on a date, derived from the run parameters."""

    as_of: dt.date
    full_load: bool
    full_start: dt.date
    lookback_days: int = LOOKBACK_DAYS

    @property
    def start(self) -> dt.date:
        if self.full_load:
            return self.full_start
        return self.as_of - dt.timedelta(days=self.lookback_days)


@dataclass(frozen=True)
class FeedParams:
    """Typed job parameters (replaces the environment switches of the source job)."""

    as_of: dt.date = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).date())
    full_load: bool = False
    lookback_days: int = LOOKBACK_DAYS
    wt_full_start: dt.date = WT_FULL_START
    cw_full_start: dt.date = CW_FULL_START

    @property
    def wt_window(self) -> LoadWindow:
        return LoadWindow(self.as_of, self.full_load, self.wt_full_start, self.lookback_days)

    @property
    def cw_window(self) -> LoadWindow:
        return LoadWindow(self.as_of, self.full_load, self.cw_full_start, self.lookback_days)


def parse_date(value: str | dt.date | None) -> dt.date | None:
    if value is None or isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value.strip())
