"""Raw facts → daily staging (this-year values at the daily grain).

Plan: scan (14 columns, filters pushed to the Parquet reader) → round each
measure to integer cents → hash aggregate on the six keys with map-side
partial aggregation (one exchange; a hot key is pre-combined in every task
before the shuffle) → join with the calendar, which the planner broadcasts → project.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import avg_as_double, round_half_up, sum_as_double, to_units

_AGGS = {
    "sum": lambda c: F.sum(c),
    "avg": lambda c: F.avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "count": lambda c: F.count(c),
}


def group_agg(df: DataFrame, keys: list[str], specs: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Generic group-aggregate: ``specs`` is ``(column, function, alias)``.

    Functions: sum, avg, min, max, count. Aliases are explicit so downstream
    code never depends on generated names like ``sum(x)``.
    """
    exprs: list[Column] = []
    for col, fn, alias in specs:
        if fn not in _AGGS:
            raise ValueError(f"unknown aggregate {fn!r}")
        exprs.append(_AGGS[fn](F.col(col)).alias(alias))
    if not exprs:
        raise ValueError("group_agg needs at least one aggregate")
    return df.groupBy(*keys).agg(*exprs)


def fact_rounded(fact: DataFrame) -> DataFrame:
    """The six keys plus every measure rounded HALF_UP to cents (decimal)."""
    return fact.select(*S.K6, *[round_half_up(m.name, S.INPUT_SCALE).alias(m.name) for m in S.METRICS])


def fact_units(fact: DataFrame) -> DataFrame:
    """The six keys plus every measure in HALF_UP-rounded integer cents (long)."""
    return fact.select(*S.K6, *[to_units(m.name, S.INPUT_SCALE).alias(m.name) for m in S.METRICS])


def daily_agg(fact: DataFrame) -> DataFrame:
    """Sum (or average, per the metric registry) each rounded measure per day and entity.

    Inputs are rounded to cents first; sums run on long cents and averages
    are rounded HALF_UP to 6 places once per group, so results are exact and
    independent of row order. Output metrics are doubles.
    """
    aggs = []
    for m in S.METRICS:
        if m.daily == "sum":
            aggs.append(sum_as_double(F.col(m.name), S.INPUT_SCALE).alias(m.name))
        else:
            aggs.append(avg_as_double(F.col(m.name), S.INPUT_SCALE, m.scale).alias(m.name))
    return fact_units(fact).groupBy(*S.K6).agg(*aggs)


def attach_calendar(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Inner join on ``period_key``: adds LY key, week and year-week; days off the calendar drop."""
    cal = calendar.select(S.PERIOD, S.LY_PERIOD, S.WEEK_ENDED, F.col("year_week").alias(S.TY_YEAR_WEEK))
    return daily.join(cal, S.PERIOD, "inner")


def flagged_staging(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every daily row in the staging layout, and ``on_calendar``: false where the calendar lacks its period."""
    cal = calendar.select(
        S.PERIOD, S.LY_PERIOD, S.WEEK_ENDED, F.col("year_week").alias(S.TY_YEAR_WEEK), F.lit(True).alias("_on_calendar")
    )
    joined = daily_agg(fact).join(cal, S.PERIOD, "left")
    return joined.select(*_staging_columns(), F.col("_on_calendar").isNotNull().alias("on_calendar"))


def _staging_columns() -> list[Column]:
    return [
        *[F.col(k) for k in S.K6],
        *[F.col(m.name).alias(m.ty) for m in S.METRICS],
        F.col(S.LY_PERIOD).cast("int").alias(S.LY_PERIOD),
        F.col(S.TY_YEAR_WEEK).cast("int").alias(S.TY_YEAR_WEEK),
        F.col(S.WEEK_ENDED),
    ]


def build_staging(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Raw facts → staging table (17 columns, unique on the six keys)."""
    return attach_calendar(daily_agg(fact), calendar).select(*_staging_columns())


def off_calendar(daily_or_fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows whose period is missing from the calendar (they drop at the calendar join)."""
    return daily_or_fact.join(calendar.select(S.PERIOD), S.PERIOD, "left_anti")
