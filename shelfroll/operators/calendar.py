"""Calendar operators: window, period ranges, LY look-back, week widening.

LY days always come from the calendar table, never from date arithmetic, so
53-week years and retailer-specific calendars work unchanged. The helpers
that return bounds run a one-row aggregate over the (small) calendar
dimension; the bounds then become static partition filters on the big scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def as_key(v: int | str | dt.date) -> int:
    """``20190624``, ``"20190624"``, ``"2019-06-24"`` or a date → int key."""
    if isinstance(v, dt.date):
        return v.year * 10000 + v.month * 100 + v.day
    if isinstance(v, int):
        return v
    s = str(v).strip()
    if len(s) == 10 and s[4] in "-/":
        return int(s[:4] + s[5:7] + s[8:10])
    return int(s)


def key_date(k: int) -> dt.date:
    """int ``yyyyMMdd`` key → date."""
    return dt.date(k // 10000, (k // 100) % 100, k % 100)


def period_between(start: int | None, end: int | None, col: str = S.PERIOD) -> Column:
    """Inclusive ``start <= col <= end``; an open side is unbounded."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(col) >= F.lit(as_key(start)))
    if end is not None:
        cond = cond & (F.col(col) <= F.lit(as_key(end)))
    return cond


def calendar_window(calendar: DataFrame, as_of: int | str | dt.date, years: int = 3) -> DataFrame:
    """Days strictly before ``as_of`` whose year is after ``year(as_of) - years``."""
    k = as_key(as_of)
    return calendar.where((F.col(S.PERIOD) < F.lit(k)) & (F.col("year") > F.lit(k // 10000 - years)))


def calendar_alias(calendar: DataFrame) -> DataFrame:
    """LY key with the TY day and week it maps forward to."""
    return calendar.select(
        S.LY_PERIOD, F.col(S.PERIOD).alias("x_period_key"), F.col(S.WEEK_ENDED).alias(S.X_WEEK_ENDED)
    )


def _bounds(df: DataFrame, col: str) -> tuple[int | None, int | None]:
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return (row["lo"], row["hi"]) if row is not None else (None, None)


def ly_bounds(calendar: DataFrame, start: int | None, end: int | None) -> tuple[int | None, int | None]:
    """Smallest and largest LY key of the calendar days in [start, end]."""
    return _bounds(calendar.where(period_between(start, end)), S.LY_PERIOD)


def forward_bounds(calendar: DataFrame, start: int | None, end: int | None) -> tuple[int | None, int | None]:
    """Range of days whose LY day lies in [start, end] (their LY values change with it)."""
    return _bounds(calendar.where(period_between(start, end, S.LY_PERIOD)), S.PERIOD)


def widen_to_weeks(calendar: DataFrame, start: int | None, end: int | None) -> tuple[int | None, int | None]:
    """Extend [start, end] to whole weeks so no week is rebuilt from part of its days."""
    if start is None and end is None:
        return None, None
    weeks = calendar.where(period_between(start, end)).select(S.WEEK_ENDED).distinct()
    days = calendar.join(weeks, S.WEEK_ENDED, "left_semi")
    lo, hi = _bounds(days, S.PERIOD)
    return (lo if start is not None else None), (hi if end is not None else None)


def week_bounds(calendar: DataFrame, start: int, end: int) -> tuple[dt.date | None, dt.date | None]:
    """First and last ``week_ended`` of the calendar days in [start, end]."""
    return _bounds(calendar.where(period_between(start, end)), S.WEEK_ENDED)

