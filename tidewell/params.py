"""One typed object carries everything a run depends on besides its tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class RunParams:
    """Arguments of a run.

    ``as_of`` replaces the wall clock everywhere, so that a rerun of the same
    inputs gives the same output.
    """

    client_id: int
    run_year: int
    as_of: datetime
    run_id: int = 0
    env: str = "DEV"
    tz: str = "UTC"

    @property
    def today(self) -> date:
        return self.as_of.date()

    @property
    def tomorrow(self) -> date:
        return self.today + timedelta(days=1)

    @property
    def is_current_year(self) -> bool:
        return self.run_year == self.as_of.year
