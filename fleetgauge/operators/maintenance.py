"""Deleting, replacing and ageing out history, as frames. The store applies them to tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.time import AsOf, months_before


def _date(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def append(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """The fact with more rows."""
    return fact.unionByName(rows.select(*fact.columns))


def delete_day(fact: DataFrame, day: dt.date) -> DataFrame:
    return fact.filter(F.col("date") != _date(day))


def delete_yesterday(fact: DataFrame, as_of: AsOf) -> DataFrame:
    return delete_day(fact, as_of.yesterday.day)


def delete_month(fact: DataFrame, year: int, month: int) -> DataFrame:
    """Drop one month of one year."""
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return fact.filter((F.col("date") < _date(first)) | (F.col("date") >= _date(after)))


def retain(fact: DataFrame, as_of: AsOf, months: int) -> DataFrame:
    """Keep the last ``months`` months."""
    return fact.filter(F.col("date") >= _date(months_before(as_of.day, months)))


def retain_daily(fact: DataFrame, as_of: AsOf) -> DataFrame:
    return retain(fact, as_of, fv.DAILY_RETENTION_MONTHS)


def retain_monthly(fact: DataFrame, as_of: AsOf) -> DataFrame:
    return retain(fact, as_of, fv.MONTHLY_RETENTION_MONTHS)


def replace_day(fact: DataFrame, day: dt.date, rows: DataFrame) -> DataFrame:
    """Recompute a day: its old rows out, the new ones in."""
    return append(delete_day(fact, day), rows)


def replace_month(fact: DataFrame, month: dt.date, rows: DataFrame) -> DataFrame:
    """Recompute a month: its old rows out, the new ones in."""
    return append(delete_month(fact, month.year, month.month), rows)


def ledger_period(as_of: AsOf, grain: str) -> dt.date:
    """Period a run counts for: the day, or the first of the month."""
    return as_of.day if grain == "day" else as_of.this_month


def ledger_pending(registry: DataFrame, ledger: DataFrame, as_of: AsOf, grain: str) -> DataFrame:
    """KPIs of one grain without a successful run in the current period.

    The ledger key has the report, so finishing one report does not skip another.
    """
    done = ledger.filter((F.col("grain") == grain) & (F.col("status") == "done"))
    period = F.col("period") if grain == "day" else F.trunc("period", "MM")
    done = done.filter(period == _date(ledger_period(as_of, grain))).select("report", "kpi")
    return registry.filter(F.col("grain") == grain).join(done, ["report", "kpi"], "left_anti")


def clear_ledger(ledger: DataFrame, grain: str, period: dt.date) -> DataFrame:
    """The ledger without the runs of one period."""
    return ledger.filter((F.col("grain") != grain) | (F.col("period") != _date(period)))
