"""Date helpers as Column expressions.

Nothing reads the wall clock inside an expression: "today" is an explicit
``as_of`` argument (a date, a date string or a Column), so a query gives the
same answer whenever it runs and Catalyst can fold the constant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats.
DATE_FORMAT = "yyyy-MM-dd"
KEY_FORMAT = "yyyyMMdd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
SLASH_DATE_FORMAT = "yyyy/MM/dd"


def _date(v: Column | str | int | dt.date) -> Column:
    """A date Column from a Column, date, ``yyyyMMdd`` int/text or ``yyyy-MM-dd`` text."""
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        return F.lit(v.date())
    if isinstance(v, dt.date):
        return F.lit(v)
    s = str(v).strip()
    if len(s) == 8 and s.isdigit():
        return F.lit(dt.date(int(s[:4]), int(s[4:6]), int(s[6:])))
    return F.lit(dt.date.fromisoformat(s.replace("/", "-")))


def today(as_of: Column | str | dt.date) -> Column:
    """``as_of`` as ``yyyy-MM-dd`` text."""
    return F.date_format(_date(as_of), DATE_FORMAT)


def days_ago(as_of: Column | str | dt.date, days: int | Column) -> Column:
    """``as_of`` minus ``days`` calendar days, as ``yyyy-MM-dd``; crosses year ends."""
    n = days if isinstance(days, Column) else F.lit(days)
    return F.date_format(F.date_sub(_date(as_of), n), DATE_FORMAT)


def yesterday(as_of: Column | str | dt.date) -> Column:
    return days_ago(as_of, 1)


def current_year(as_of: Column | str | dt.date) -> Column:
    return F.year(_date(as_of))


def to_period_key(d: Column | str) -> Column:
    """Date → ``yyyyMMdd`` text."""
    col = F.col(d) if isinstance(d, str) else d
    return F.date_format(col, KEY_FORMAT)


def period_key_int(d: Column | str) -> Column:
    """Date → ``yyyyMMdd`` integer key."""
    col = F.col(d) if isinstance(d, str) else d
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def parse_period_key(s: Column | str) -> Column:
    """``yyyyMMdd`` text → date; null for malformed or impossible dates."""
    col = F.col(s) if isinstance(s, str) else s
    return F.try_to_date(col.cast("string"), KEY_FORMAT)



def run_timestamp(ts: Column | str) -> Column:
    """Timestamp → ``yyyy-MM-dd HH:mm:ss`` (minutes and seconds in their places)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, TIMESTAMP_FORMAT)


def day_of_week(s: Column | str, as_of: Column | str | dt.date) -> Column:
    """Weekday name (``"Monday"``) of a ``yyyy-MM-dd`` or ``yyyy/MM/dd`` string.

    Null input means ``as_of``; unparseable or impossible dates give null
    instead of an error text.
    """
    col = F.col(s) if isinstance(s, str) else s
    parsed = F.try_to_date(F.translate(col, "-", "/"), SLASH_DATE_FORMAT)
    return F.date_format(F.when(col.isNull(), _date(as_of)).otherwise(parsed), "EEEE")


def in_date_range(path: Column | str, start: str | dt.date, end: str | dt.date) -> Column:
    """True when the last 8 characters of ``path`` are a ``yyyyMMdd`` date in [start, end].

    Shorter strings and unparseable tails are false, never errors.
    """
    col = F.col(path) if isinstance(path, str) else path
    tail = F.when(F.length(col) >= 8, F.substring(col, -8, 8))
    d = F.try_to_date(tail, KEY_FORMAT)
    return F.coalesce(d.between(_date(start), _date(end)), F.lit(False))
