"""Calendar dimension.

The source generates days with a recursive CTE; here one aggregate finds
the first and last sale day and ``sequence`` + ``explode`` emits the days.
The output size is bounded by the number of days in the range, not by the
number of sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D


def date_bounds(txn: DataFrame, ts_col: str = "transaction_datetime") -> DataFrame:
    """One row: first and last calendar day of the sales (A2)."""
    day = D.to_day(ts_col)
    return txn.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def calendar(bounds: DataFrame, lo: str = "min_date", hi: str = "max_date") -> DataFrame:
    """One row per day from ``lo`` to ``hi`` inclusive; NULL bounds -> no rows."""
    days = F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("full_date"))


def date_attributes(days: DataFrame, c: str = "full_date") -> DataFrame:
    """Calendar columns of each day: key yyyymmdd, weekday (Sunday = 1), names, month, quarter, year."""
    d = F.col(c)
    return days.select(
        D.date_key(d).alias("date_key"),
        d.alias("full_date"),
        D.day_of_week_num(d).alias("day_of_week_num"),
        D.day_name(d).alias("day_of_week_name"),
        F.month(d).alias("month_number"),
        D.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def build_dim_date(txn: DataFrame, ts_col: str = "transaction_datetime") -> DataFrame:
    """Calendar from the first to the last sale day."""
    return date_attributes(calendar(date_bounds(txn, ts_col)))
