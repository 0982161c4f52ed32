"""Calendar attributes of a DATE column (F1-F10), PostgreSQL-compatible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: TO_CHAR 'Month' / 'Day' pad names with blanks to 9 characters.
NAME_WIDTH = 9


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def month_name(d: Column, padded: bool = True) -> Column:
    name = F.date_format(d, "MMMM")
    return F.rpad(name, NAME_WIDTH, " ") if padded else name


def day_name(d: Column, padded: bool = True) -> Column:
    name = F.date_format(d, "EEEE")
    return F.rpad(name, NAME_WIDTH, " ") if padded else name


def day_of_week(d: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def is_month_end(d: Column) -> Column:
    return d == F.last_day(d)


def is_quarter_end(d: Column) -> Column:
    return d == F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1)


def calendar_columns(d: Column, padded_names: bool = True) -> list[Column]:
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("short").alias("year"),
        F.quarter(d).cast("short").alias("quarter"),
        F.month(d).cast("short").alias("month"),
        month_name(d, padded_names).alias("month_name"),
        F.weekofyear(d).cast("short").alias("week_of_year"),
        day_of_week(d).cast("short").alias("day_of_week"),
        day_name(d, padded_names).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
        is_month_end(d).alias("is_month_end"),
        is_quarter_end(d).alias("is_quarter_end"),
    ]
