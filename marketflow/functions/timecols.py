"""Time columns. All times are TIMESTAMP_NTZ holding UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at(as_of: datetime | Column) -> Column:
    """``as_of`` as a column: a literal folds into the plan and is pushed down."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def latest(df: DataFrame, time_col: str) -> Column:
    """Largest value of a time column as a scalar subquery (evaluated once, no join)."""
    return df.agg(F.max(time_col)).scalar()


def before(as_of: datetime | Column, *, days=0, hours=0, minutes=0, seconds=0) -> Column:
    """The instant that lies the given span before ``as_of``."""
    span = F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(float(seconds)))
    return at(as_of) - span


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def bucket(ts: Column, width: str) -> Column:
    """Start of the tumbling bucket of ``width`` (for instance ``1 minute``)."""
    return F.window(ts, width).start


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole second boundaries crossed from ``start`` to ``end``."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")
