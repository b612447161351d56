"""Time expressions relative to an explicit moment. Nothing here reads the clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """The moment a run stands for: a day, and the time of day used for elapsed days."""

    day: dt.date
    time: dt.time = dt.time(8, 0)

    @property
    def today(self) -> Column:
        return F.lit(self.day.isoformat()).cast("date")

    @property
    def now(self) -> Column:
        return F.lit(dt.datetime.combine(self.day, self.time).isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def yesterday(self) -> AsOf:
        return AsOf(self.day - dt.timedelta(days=1), self.time)

    @property
    def previous_month(self) -> dt.date:
        """First day of the month before."""
        return (self.day.replace(day=1) - dt.timedelta(days=1)).replace(day=1)

    @property
    def this_month(self) -> dt.date:
        return self.day.replace(day=1)


def day_age(c: Column | str, as_of: AsOf) -> Column:
    """Whole calendar days between a date or timestamp and the run day."""
    c = F.col(c) if isinstance(c, str) else c
    return F.datediff(as_of.today, c.cast("date"))


def elapsed_days(c: Column | str, as_of: AsOf) -> Column:
    """Elapsed whole days up to the run moment, truncated toward zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.extract(F.lit("DAY"), as_of.now - c.cast("timestamp_ntz"))


def days_after_is_now(start: Column | str, days: int, as_of: AsOf) -> Column:
    """Is the run moment less than a day away, on either side, from ``start`` + ``days``."""
    start = F.col(start) if isinstance(start, str) else start
    return elapsed_days(F.date_add(start.cast("date"), days), as_of) == 0


def previous_month(c: Column | str) -> Column:
    """First day of the month before a date column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(F.add_months(c.cast("date"), -1), "MM")


def months_before(day: dt.date, months: int) -> dt.date:
    """Same day ``months`` earlier, clamped to the end of a shorter month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    first_next = dt.date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    last = (first_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))
