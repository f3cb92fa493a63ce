"""Reference time and the two "last N days" rules."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

ROLLING = "rolling"
CALENDAR = "calendar"


def moment(as_of=None) -> datetime:
    """The reference time as a naive UTC datetime; None means now."""
    if as_of is None:
        return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if not isinstance(as_of, datetime):
        return datetime.combine(as_of, time())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of


def window_start(as_of, days: int, mode: str = ROLLING) -> datetime:
    """Start of the last ``days`` days.

    ``rolling`` counts 24-hour days back from the reference time; ``calendar``
    takes the reference date and the ``days`` dates before it, whole.
    """
    now = moment(as_of)
    if mode == ROLLING:
        return now - timedelta(days=days)
    if mode == CALENDAR:
        return datetime.combine(now.date() - timedelta(days=days), time())
    raise ValueError(f"unknown window mode: {mode!r}")


def ntz(value: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ', timespec='microseconds')}'")


def day(value: date) -> Column:
    return F.expr(f"DATE '{date_text(value)}'")


def date_text(value: date) -> str:
    """As folders of dates are named: four digits of the year, also before 1000."""
    return date(value.year, value.month, value.day).isoformat()


def since(start: datetime) -> Column:
    """Events at or after ``start``, with no upper bound.

    The date term is implied by the time term, but only it can prune
    partitions; the time term reaches the Parquet row groups.
    """
    return (F.col("created_at_date") >= day(start)) & (F.col("created_at") >= ntz(start))


def last_days(days: int, as_of=None, mode: str = ROLLING) -> Column:
    return since(window_start(as_of, days, mode))


def dates_in(df: DataFrame, date_column: str) -> set[date]:
    """The dates that occur; as many values as there are calendar days at most.

    A date that Python cannot hold is left out: it must not end a load.
    """
    held = df.where(F.col(date_column).between(day(date.min), day(date.max)))
    return {row[0] for row in held.select(date_column).distinct().collect()}
