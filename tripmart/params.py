"""Query and build parameters.

The reference hard-codes the year 2024, the calendar 2022-01-01..2025-12-31
and HAVING thresholds of 1000/10/100 trips. They are parameters here; the
defaults are the reference's values. ``TESTDATA`` holds the values used
with the driver's TPC-H-shaped tables (orders span 1995-2001).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    year: int = 2024
    calendar_start: dt.date = dt.date(2022, 1, 1)
    calendar_end: dt.date = dt.date(2025, 12, 31)
    top_n: int = 10
    top_per_group: int = 5
    q13_min_trips: int = 1000
    q17_min_trips: int = 10
    q19_min_trips: int = 100
    q17_max_speed: int = 100
    grid_first_year: int = 2022
    grid_last_year: int = 2025
    # Tests (table, column, test) whose violations are reported but do not hold back publication.
    tolerated: tuple = ()
    # Dimensions whose rows are bounded by construction are broadcast up to this many.
    max_broadcast_rows: int = 2_000_000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def month_lo(self) -> str:
        return f"{self.year:04d}-01"

    @property
    def month_hi(self) -> str:
        return f"{self.year:04d}-12"

    @property
    def year_start(self) -> dt.datetime:
        return dt.datetime(self.year, 1, 1)

    @property
    def next_year_start(self) -> dt.datetime:
        return dt.datetime(self.year + 1, 1, 1)


REFERENCE = Params()

# The driver's tables: orders 1995-01..2001-08, ship dates up to 2001-11.
# The calendar ends before the last ship dates on purpose, so the
# dropoff-date foreign-key test has real violations to report.
TESTDATA = Params(
    year=1996,
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2000, 12, 31),
    q13_min_trips=100,
    q17_min_trips=10,
    q19_min_trips=100,
    # Backfill grid wider than the data, so some slices are pending.
    grid_first_year=1994,
    grid_last_year=2002,
    tolerated=(("fct_trips", "pickup_date_key", "relationships"),
               ("fct_trips", "dropoff_date_key", "relationships")),
)
