"""Months as `yyyy-MM` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def month_anchor(run_date: Column, lag_months: int) -> Column:
    """First day of the month that lies `lag_months` before the run's month."""
    return F.add_months(F.trunc(run_date, "month"), -lag_months)


def months_back(anchor: Column, count: int) -> Column:
    """Array of `count` month starts, newest first, beginning at `anchor`."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.add_months(anchor, -i))
