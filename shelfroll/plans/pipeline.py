"""The three stages wired over the stand-in inputs (used by queries and bench).

Nothing is collected. Plans that need staging twice (this year and last year) take it
from a flat table in the shared scratch folder, so that the facts are joined and
aggregated once. The calendar is written once per session and test folder
(see ``stored.py``): it is derived from the fact dates, and as a small Parquet
file the planner knows its size and broadcasts it. The calendar window is the
fixture's (as-of 2001-12-31, three years), see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.calendar import calendar_window
from ..operators.compare import build_daily, build_daily_chained
from ..operators.rollup import build_staging
from ..operators.weekly import build_weekly, build_weekly_joined
from ..session import scratch_path
from ..sources import fixtures
from ..sources.tables import read_calendar
from .oracle import AS_OF, YEARS


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in calendar, read from its stored file."""
    from .stored import RETAILER, stored  # stored.py writes the stage outputs through this module

    return read_calendar(spark, stored(spark, sf_dir, "dims"), RETAILER)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in facts: a lazy plan over the test tables."""
    return fixtures.fact(spark, sf_dir)


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fact(spark, sf_dir), calendar(spark, sf_dir)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cal = inputs(spark, sf_dir)
    return build_staging(fact, cal)


def staging_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging computed here and now, into a new flat table: for plans that read it more than once."""
    rows = staging(spark, sf_dir)
    path = scratch_path(spark, "staging-rows")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def daily(spark: SparkSession, sf_dir: str, chained: bool = False, strategy: str = "join") -> DataFrame:
    stg = staging_once(spark, sf_dir)
    window = calendar_window(calendar(spark, sf_dir), AS_OF, YEARS)
    return build_daily_chained(stg, window) if chained else build_daily(stg, window, strategy=strategy)


def weekly(spark: SparkSession, sf_dir: str, form: str = "aggregate") -> DataFrame:
    """``form``: ``aggregate`` (one hash aggregate), ``joined`` (max_by parts
    left-joined) or ``selfjoin`` (three-step arg-max joins, chained daily)."""
    d = daily(spark, sf_dir, chained=(form == "selfjoin"))
    if form == "aggregate":
        return build_weekly(d)
    return build_weekly_joined(d, selfjoin=(form == "selfjoin"))
