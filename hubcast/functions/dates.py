"""Date expressions (D1, D8, D10, D11). All pure Catalyst, DateType only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import weekday_number


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_end(date, end_day: str = "Saturday") -> Column:
    """Last day of the week containing ``date`` when weeks end on ``end_day``.

    A date already on ``end_day`` maps to itself; the shift is 0..6 days.
    ``weekday`` is Monday=0 in Spark, so weekday+1 is Monday=1..Sunday=7.
    """
    e = weekday_number(end_day)
    d = _col(date)
    return F.date_add(d, F.pmod(F.lit(e) - (F.weekday(d) + 1), F.lit(7)))


def saturday_of_week(date) -> Column:
    """Saturday closing the Sunday-to-Saturday week of ``date``."""
    return week_end(date, "Saturday")


def default_target_end_date(forecast_date, horizon) -> Column:
    """Previous Saturday (or the day itself on Saturdays) plus 7 days per horizon.

    ``dayofweek`` is Sunday=1..Saturday=7, the same convention the formula
    was written for.
    """
    fd = _col(forecast_date)
    h = _col(horizon).cast("int")
    return F.date_add(fd, F.lit(7) - F.dayofweek(fd) - F.lit(7) + F.lit(7) * h)


def weeks_since_epoch(saturday) -> Column:
    """Whole weeks between the Saturday 1970-01-03 and ``saturday``."""
    return F.floor(F.datediff(_col(saturday), F.lit("1970-01-03").cast("date")) / 7).cast("int")
