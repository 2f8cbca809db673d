"""Report calendars.

A calendar is the short list of dates a run evaluates.  It is a parameter of
the plan (a literal date list in the scan filter), never a table to join, and
always ends at a given day: no function here reads the clock.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence
from datetime import date, timedelta


@dataclass(frozen=True)
class Period:
    """An evaluated date and the date that counts as the one before it."""

    day: date
    before: date


def month_ends(first: date, as_of: date) -> list[Period]:
    """The last day before each month start from ``first`` to ``as_of``."""
    starts = []
    start = first.replace(day=1)
    while start <= as_of:
        starts.append(start)
        start = _next_month(start)
    return [Period(s - timedelta(1), _previous_month(s) - timedelta(1)) for s in starts]


def every(first: date, as_of: date, days: int) -> list[Period]:
    """``first`` and every so many days after it, up to ``as_of``."""
    step = timedelta(days)
    count = (as_of - first) // step + 1
    return [Period(first + i * step, first + (i - 1) * step) for i in range(max(count, 0))]


def weekly(first: date, as_of: date) -> list[Period]:
    return every(first, as_of, 7)


def biweekly(first: date, as_of: date) -> list[Period]:
    return every(first, as_of, 14)


def daily(as_of: date) -> list[Period]:
    """The day before ``as_of``."""
    yesterday = as_of - timedelta(1)
    return [Period(yesterday, yesterday - timedelta(1))]


def days(periods: list[Period]) -> list[date]:
    return [p.day for p in periods]


def _next_month(start: date) -> date:
    return date(start.year + start.month // 12, start.month % 12 + 1, 1)


def _previous_month(start: date) -> date:
    return (start - timedelta(1)).replace(day=1)


def months_spanned(dates: Sequence[date]) -> int:
    """Months from the first date's to the last one's, both counted, whatever lies between."""
    first, last = min(dates), max(dates)
    return 12 * (last.year - first.year) + last.month - first.month + 1
