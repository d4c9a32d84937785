"""Reporting periods (P1-P5): window bounds on the driver and as Column expressions.

A window is the half-open date range ``[start, end)`` that contains a given day:

* daily     -> the day itself
* weekly    -> Monday of that week, plus 7 days
* monthly   -> first day of the month, plus 1 month
* quarterly -> first day of the calendar quarter, plus 3 months

Bounds are computed once on the driver and passed to Spark as literals, so the
filters stay sargable (``col >= start AND col < end``) and reach the Parquet scan
as pushed filters / partition filters.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DAILY, WEEKLY, MONTHLY, QUARTERLY = "daily", "weekly", "monthly", "quarterly"
FREQUENCIES = (DAILY, WEEKLY, MONTHLY, QUARTERLY)

# Frequency names used by the report index (fixed values of the index table).
FREQUENCY_LABELS = {DAILY: "Diario", WEEKLY: "Semanal", MONTHLY: "Mensual",
                    QUARTERLY: "Trimestral"}


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    if isinstance(d, str):
        s = d.strip().replace("/", "-")
        if len(s) == 8 and s.isdigit():
            return dt.date(int(s[:4]), int(s[4:6]), int(s[6:]))
        return dt.date.fromisoformat(s[:10])
    raise TypeError(f"not a date: {d!r}")


def _first_of_month_after(d: dt.date, n: int) -> dt.date:
    """First day of the month ``n`` months after the month of ``d``."""
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1)


@dataclass(frozen=True)
class Window:
    """Half-open date range of one reporting period."""

    frequency: str
    start: dt.date
    end: dt.date

    def contains(self, d) -> bool:
        d = _as_date(d)
        return self.start <= d < self.end

    @property
    def days(self) -> int:
        return (self.end - self.start).days


def window_for(day, frequency: str) -> Window:
    """Window of ``frequency`` that contains ``day`` (a date, datetime or text).

    A datetime with a time part is cast to its date first, which is the fix for
    the legacy defect where a DATETIME parameter matched no DATE row.
    """
    d = _as_date(day)
    if frequency == DAILY:
        return Window(frequency, d, d + dt.timedelta(days=1))
    if frequency == WEEKLY:
        start = d - dt.timedelta(days=d.weekday())  # Monday
        return Window(frequency, start, start + dt.timedelta(days=7))
    if frequency == MONTHLY:
        start = d.replace(day=1)
        return Window(frequency, start, _first_of_month_after(start, 1))
    if frequency == QUARTERLY:
        start = dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
        return Window(frequency, start, _first_of_month_after(start, 3))
    raise ValueError(f"unknown frequency {frequency!r}")


def period_start(c: Column | str, frequency: str) -> Column:
    """Column: first day of the period that contains ``c`` (DATE)."""
    c = F.col(c) if isinstance(c, str) else c
    d = F.to_date(c)
    if frequency == DAILY:
        return d
    if frequency == WEEKLY:
        return F.trunc(d, "week")
    if frequency == MONTHLY:
        return F.trunc(d, "month")
    if frequency == QUARTERLY:
        return F.trunc(d, "quarter")
    raise ValueError(f"unknown frequency {frequency!r}")


def period_end(c: Column | str, frequency: str) -> Column:
    """Column: first day after the period that contains ``c`` (exclusive end)."""
    s = period_start(c, frequency)
    if frequency == DAILY:
        return F.date_add(s, 1)
    if frequency == WEEKLY:
        return F.date_add(s, 7)
    if frequency == MONTHLY:
        return F.add_months(s, 1)
    return F.add_months(s, 3)


def in_window(c: Column | str, w: Window) -> Column:
    """Sargable half-open range predicate; NULL never matches.

    The bounds are literals of the column's own kind so Catalyst pushes the
    predicate into the Parquet scan without wrapping the column in a cast.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(w.start)) & (c < F.lit(w.end))


def overlapping_periods(c: Column | str, w: Window) -> Column:
    """Periods that share days with the window, whatever frequency they were
    stored under: those that start inside it, and the week, month or quarter
    that contains its first day. Literal dates only, so it prunes partitions."""
    c = F.col(c) if isinstance(c, str) else c
    first = sorted({window_for(w.start, f).start for f in FREQUENCIES} - {w.start})
    return in_window(c, w) | c.isin(first)


def on_day(c: Column | str, day) -> Column:
    """Daily equality on the date part (P1, F1); a datetime parameter is cast first."""
    return in_window(c, window_for(day, DAILY))


def minute_rounded(c: Column | str) -> Column:
    """Load timestamp rounded to the nearest minute, as a smalldatetime stores it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("minute", c + F.expr("INTERVAL 30 SECONDS")).cast("timestamp_ntz")


def weekday_offset_start(c: Column | str) -> Column:
    """The legacy procedures' own weekly formula written with Spark functions:
    ``day - ((weekday + 5) % 7)`` with Sunday = 1 (DATEFIRST 7). Same result as
    ``trunc(day, 'week')``; kept to prove the equivalence in tests."""
    c = F.to_date(F.col(c) if isinstance(c, str) else c)
    return F.date_sub(c, ((F.dayofweek(c) + 5) % 7).cast("int"))
