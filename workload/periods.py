"""Evaluated dates of the test runs (rules in FIXTURES.md).

The last date of every run is on or after the newest order, so each run works
on the whole tables.
"""

from __future__ import annotations

from datetime import date

from riskbook.plans.cadence import BIWEEK, DAY, MONTH, WEEK
from riskbook.sources.calendar import Period, biweekly, daily, month_ends, weekly

DETAIL_FROM = date(2001, 5, 1)

# A month run over every month-end since the first order, and over every third of them.
HISTORY = "history"
GAPS = "gaps"


def periods(cadence: str) -> list[Period]:
    if cadence == MONTH.name:
        return month_ends(date(2001, 3, 1), date(2001, 9, 1))
    if cadence == HISTORY:
        return month_ends(date(1995, 2, 1), date(2001, 9, 1))
    if cadence == GAPS:
        return periods(HISTORY)[1::3]
    if cadence == WEEK.name:
        return weekly(date(2001, 6, 14), date(2001, 8, 2))
    if cadence == BIWEEK.name:
        return biweekly(date(2001, 6, 21), date(2001, 8, 2))
    if cadence == DAY.name:
        # The day before gives the reported day its prior state.
        return daily(date(2001, 8, 1)) + daily(date(2001, 8, 2))
    raise ValueError(cadence)


def by_month(cadence: str) -> bool:
    return cadence in (MONTH.name, HISTORY, GAPS)


def reported(cadence: str) -> list[date]:
    """Dates a report of the cadence covers."""
    days = [p.day for p in periods(cadence)]
    return days[-1:] if cadence == DAY.name else days
