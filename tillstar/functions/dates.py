"""Date and time expressions: parsing dd-mm-yyyy text, calendar attributes."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import ColumnOrName, blank_to_null, col

# Fixed values of the raw feeds.
DATE_FMT = "d-M-yyyy"              # dd-mm-yyyy; one or two digits accepted
_DATETIME = "^([0-9-]+) ([0-9]{1,2}):([0-9]{1,2})$"
OUT_DATE_FMT = "dd-MM-yyyy"        # export format of the raw files
OUT_DATETIME_FMT = "dd-MM-yyyy HH:mm"
OPEN_END = _dt.date(9999, 12, 31)  # valid_to of an open version
GUEST_FROM = _dt.date(1900, 1, 1)  # valid_from of the Guest member


def to_date_dmy(c: ColumnOrName) -> Column:
    """'dd-mm-yyyy' -> DATE; blank, bad or impossible dates -> NULL."""
    return F.try_to_date(blank_to_null(c), DATE_FMT)


def to_datetime_dmy(c: ColumnOrName) -> Column:
    """'dd-mm-yyyy hh:mm' -> TIMESTAMP_NTZ; bad text -> NULL.

    Day and time of day are read apart and put together without a zone, so
    no hour is moved by a session zone's daylight-saving gap.
    """
    text = blank_to_null(c)
    day = F.try_to_date(F.regexp_extract(text, _DATETIME, 1), DATE_FMT)
    part = [F.regexp_extract(text, _DATETIME, i).try_cast("int") for i in (2, 3)]
    time = F.make_dt_interval(F.lit(0), *part)
    return F.when((part[0] < 24) & (part[1] < 60), day.cast("timestamp_ntz") + time)


def to_day(c: ColumnOrName) -> Column:
    """Datetime -> calendar date."""
    return col(c).cast("date")


def date_key(c: ColumnOrName) -> Column:
    """Date -> integer yyyymmdd."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week_num(c: ColumnOrName) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(col(c))


def day_name(c: ColumnOrName) -> Column:
    """Full English day name, e.g. 'Sunday' (T17)."""
    return F.date_format(col(c), "EEEE")


def month_name(c: ColumnOrName) -> Column:
    """Full English month name, e.g. 'January' (T17)."""
    return F.date_format(col(c), "MMMM")


def fmt_dmy(c: ColumnOrName) -> Column:
    """Date -> 'dd-mm-yyyy' text."""
    return F.date_format(col(c), OUT_DATE_FMT)


def fmt_dmy_hm(c: ColumnOrName) -> Column:
    """Datetime -> 'dd-mm-yyyy hh:mm' text."""
    return F.date_format(col(c), OUT_DATETIME_FMT)


def active_on(start: ColumnOrName, end: ColumnOrName, as_of) -> Column:
    """Whether the closed interval [start, end] covers ``as_of``."""
    d = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return d.between(col(start), col(end))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days from one date to another, negative if it lies before."""
    return F.date_diff(col(end), col(start))


def as_date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, str):
        v = _dt.date.fromisoformat(v)
    return F.lit(v).cast("date")
