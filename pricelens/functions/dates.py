"""Date helpers: week start, next weekday, future week sequences."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(ts: Column) -> Column:
    """Monday of the week holding ``ts`` (timestamp or date) as a DATE."""
    return F.trunc(F.to_date(ts), "week")


def as_of_column(as_of) -> Column:
    """``as_of`` given as None (today), a date/str, or a Column."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def future_weeks(last_date: Column, n: int, weekday: str = "Sun") -> Column:
    """Array of ``n`` dates, 7 days apart, the first being the next ``weekday``
    strictly after ``last_date``."""
    first = F.next_day(last_date, weekday)
    return F.sequence(first, F.date_add(first, 7 * (n - 1)), F.expr("INTERVAL 7 DAYS"))
