"""Date and time expressions. Anything relative to "now" takes an explicit as-of date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_of_date(as_of: dt.date | str | None) -> Column:
    """A DATE literal, or today when no date is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_ago(as_of: dt.date | str | None, days: int) -> Column:
    return F.date_sub(as_of_date(as_of), days)


def day(column: str | Column) -> Column:
    return F.to_date(column)


def month_start(column: str | Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(column, "MM")


def week_start(column: str | Column) -> Column:
    """The Sunday on or before the date."""
    return F.date_sub(day(column), F.dayofweek(column) - 1)


def months_apart(later: str | Column, earlier: str | Column) -> Column:
    """Calendar months between two dates: 31 January to 1 February is one month."""
    later, earlier = _column(later), _column(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970, the sub-second part cut off.

    A timestamp without time zone is read as written, whatever the session's zone.
    """
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        whole_days = F.datediff(F.to_date(value), F.lit("1970-01-01").cast("date")).cast("bigint")
        return (
            whole_days * 86400
            + F.hour(value) * 3600
            + F.minute(value) * 60
            + F.second(value)
        )
    return F.unix_seconds(value.cast("timestamp"))


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
