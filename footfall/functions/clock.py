"""Time expressions. Every clock is an ``as_of`` argument, so a report can be re-run for a past moment."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of: datetime | str | Column | None = None) -> Column:
    """The clock: ``as_of`` when given, otherwise now, as a zoneless timestamp."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of.isoformat(sep=" ") if isinstance(as_of, (datetime, date)) else as_of
    return F.lit(text).cast("timestamp_ntz")


def event_hour(ts: str | Column = "event_timestamp") -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def whole_seconds(ts: str | Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def event_day(ts: str | Column = "event_timestamp") -> Column:
    return F.to_date(ts)


def event_month(ts: str | Column = "event_timestamp") -> Column:
    """yyyyMM as an integer: the partition column of every table stored by month."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def before(as_of, *, days: int = 0, hours: int = 0) -> Column:
    """The moment ``days`` and ``hours`` before the clock."""
    return (moment(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))).cast("timestamp_ntz")


def age_hours(ts: str | Column, as_of=None) -> Column:
    return F.timestamp_diff("MICROSECOND", ts, moment(as_of)) / F.lit(3.6e9)


def since(df: DataFrame, cutoff: Column, column: str = "event_timestamp") -> DataFrame:
    """Rows at or after ``cutoff``; prunes whole months where the table is stored by month."""
    kept = df.filter(F.col(column) >= cutoff)
    if "event_month" in df.columns:
        kept = kept.filter(F.col("event_month") >= event_month(cutoff))
    return kept
