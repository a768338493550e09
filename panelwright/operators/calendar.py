"""Trading calendar lookups. A calendar is a frame with one ``date`` per session."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(calendar: DataFrame) -> DataFrame:
    """``date`` and ``previous_date``; a calendar is a few hundred rows a year, so one ordering is fine."""
    return calendar.select("date").withColumn("previous_date", F.lag("date").over(Window.orderBy("date")))


def last_sessions(calendar: DataFrame, current: date, n: int = 1) -> DataFrame:
    """The ``n`` sessions before ``current``, ascending.

    A day without a session counts as the next session after it, so a Saturday gives Friday. A day after
    the calendar's end is an error.
    """
    anchor = calendar.where(F.col("date") >= F.lit(current)).agg(F.min("date")).scalar()
    known = F.coalesce(anchor, F.raise_error(F.lit(f"{current} is after the last session")).cast("date"))
    return calendar.select("date").where(F.col("date") < known).orderBy(F.desc("date")).limit(n).orderBy("date")


def session_list(calendar: DataFrame, current: date, n: int = 1) -> list[date]:
    """``last_sessions`` as a list of at most ``n`` dates."""
    return [row["date"] for row in last_sessions(calendar, current, n).collect()]
