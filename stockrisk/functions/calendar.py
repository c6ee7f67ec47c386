"""Calendar attributes of a date column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockrisk.constants import MONTH_NAME_FORMAT


def day_of_week_iso(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7 (Spark's ``dayofweek`` starts on Sunday)."""
    return (F.weekday(d) + 1).cast("bigint")


def calendar_parts(d: Column) -> list[Column]:
    """The dimension attributes in column order; numbers are bigint.

    ``week_num`` is the ISO week while ``year_num`` is the calendar year, so
    2024-12-30 is week 1 of year 2024 -- kept as defined.
    """
    return [
        F.year(d).cast("bigint").alias("year_num"),
        F.quarter(d).cast("bigint").alias("quarter_num"),
        F.month(d).cast("bigint").alias("month_num"),
        F.date_format(d, MONTH_NAME_FORMAT).alias("month_name"),
        F.weekofyear(d).cast("bigint").alias("week_num"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        day_of_week_iso(d).alias("day_of_week_num"),
    ]
