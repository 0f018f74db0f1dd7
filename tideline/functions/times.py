"""Wall clocks, instants and what is derived from them."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | str | Column) -> Column:
    """Literal instant; a value without a zone is UTC, whatever zone the driver process is in."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, datetime):
        moment = (moment.astimezone(timezone.utc) if moment.tzinfo else moment).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(moment).cast("timestamp")


def local_to_instant(wall_clock: Column, zone: str) -> Column:
    """Instant of a zone-less wall clock.  Needs the session zone to be UTC.

    A time that occurs twice in autumn is the earlier one; a time skipped in spring
    keeps the offset from before the change.
    """
    return F.to_utc_timestamp(wall_clock, zone)


def local_parts(wall_clock: Column) -> dict[str, Column]:
    """Date, hour and day of week (Sunday = 1) as the clock on the wall showed them."""
    return {
        "date": F.to_date(wall_clock),
        "hour": F.hour(wall_clock),
        "day_of_week": F.dayofweek(wall_clock),
    }


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds between two instants in minutes; negative values are kept.

    Divided as a decimal, so the result carries six decimals before the cast.
    """
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return (seconds / F.lit(Decimal("60.0"))).cast("double")
