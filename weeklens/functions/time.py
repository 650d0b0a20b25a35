"""Week arithmetic as native column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def seven_days() -> Column:
    return F.expr("INTERVAL 7 DAYS")


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week holding ``ts`` (pandas ``to_period('W').start_time``)."""
    return F.date_trunc("week", ts.cast("timestamp"))


def week_spine(first: Column | dt.datetime, last: Column | dt.datetime) -> Column:
    """Array of every Monday from ``first`` to ``last`` inclusive (S3)."""
    if not isinstance(first, Column):
        first = F.lit(first).cast("timestamp")
    if not isinstance(last, Column):
        last = F.lit(last).cast("timestamp")
    return F.sequence(first, last, seven_days())


def next_week(week: Column) -> Column:
    """One week later."""
    return week + seven_days()


def iso_week(ts: Column) -> Column:
    """ISO week of year (2024-12-30 -> 1)."""
    return F.weekofyear(ts)
