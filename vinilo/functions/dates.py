"""Date expressions. Names of days and months are English."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_time(df: DataFrame, column: str) -> Column:
    """The column as a point in time; text that is no date gives NULL."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("timestamp_ntz")
    return F.col(column)


def day(df: DataFrame, column: str) -> Column:
    return F.to_date(event_time(df, column))


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5
