"""Calendar attributes of a date column (the DimDate row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Smart key yyyymmdd as INT."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(d: Column) -> Column:
    """First day of the month (the day after the previous month's end)."""
    return F.trunc(d, "MM")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def calendar_columns(d: Column) -> list[Column]:
    """The ten DimDate columns for date column ``d``."""
    return [
        date_key(d).alias("DateKey"),
        d.alias("DateValue"),
        F.year(d).cast("smallint").alias("Year"),
        F.month(d).cast("smallint").alias("Month"),
        F.dayofmonth(d).cast("smallint").alias("Day"),
        F.quarter(d).cast("smallint").alias("Quarter"),
        month_start(d).alias("StartOfMonth"),
        month_end(d).alias("EndOfMonth"),
        month_name(d).alias("MonthName"),
        day_name(d).alias("DayOfWeekName"),
    ]
