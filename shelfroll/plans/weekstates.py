"""The stored weekly states of a job: when they may be used, and how they follow the daily table.

States lie beside the weekly table, by (vendor, week). They must stand for the daily table as it is, so a marker file
is set before a job changes daily and goes when states and weekly are written. A job that finds the marker of a killed
one drops the states; they come back week by week, from whole weeks, with the loads that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.weekstate import STATE_COLUMNS, STATE_SCHEMA, advanced, consistent
from ..sources import storage
from ..sources.params import JobParams
from ..sources.partitions import partition_list
from ..sources.tables import read_daily, read_dataset
from . import sinks
from .scope import JobScope, within


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}__open"


def begin(spark: SparkSession, path: str) -> None:
    """From here on daily may differ from the states of ``path``; states a killed job left so are dropped."""
    if storage.exists(spark, _marker(path)):
        storage.drop(spark, path)
    storage.touch(spark, _marker(path))


def end(spark: SparkSession, path: str) -> None:
    """States and daily agree again."""
    storage.delete(spark, _marker(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, STATE_SCHEMA).select(*STATE_COLUMNS)


def _partitions(spark: SparkSession, path: str, cols: list[str]) -> DataFrame | None:
    """Stored partitions of a dataset; None where it has no file."""
    if not storage.exists(spark, storage.resolved(spark, path)):
        return None
    files = storage.data_files(spark, path)
    return partition_list(spark, path, cols, files) if set(cols) <= set(files.columns) else None


def covered(spark: SparkSession, params: JobParams, calendar: DataFrame, scope: JobScope) -> bool:
    """Whether all vendors and weeks of the scope that have daily rows have states. Only partition names are read."""
    days = _partitions(spark, params.daily_path, S.DAILY_PARTITIONS)
    states = _partitions(spark, params.week_state_path, S.WEEKLY_PARTITIONS)
    if days is None or states is None:
        return False
    week_of = calendar.select(S.PERIOD, S.WEEK_ENDED).distinct()
    days = days.where(sinks.vendor_scope(params.vendors) & within(scope.weeks))
    weeks = days.join(week_of, S.PERIOD, "left").select(S.VENDOR, S.WEEK_ENDED).distinct()
    have = states.select(*[F.col(c).alias(f"_{c}") for c in S.WEEKLY_PARTITIONS])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in S.WEEKLY_PARTITIONS]
    return weeks.join(have, same, "left_anti").isEmpty()


def follow(spark: SparkSession, params: JobParams, scope: JobScope, weeks: Column, after: DataFrame, path: str) -> bool:
    """Writes to ``path`` the states of the vendors' ``weeks`` after their daily rows of the scope become ``after``.

    Reads the states of these weeks and the stored days that ``after`` replaces, no other day. False where the result
    can't be right (rows taken from states that never held them, or weeks beyond ``weeks``, as after a change of the
    calendar): the weeks are then to be built whole.
    """
    before = read_daily(spark, params.daily_path, vendors=params.vendors).where(within(scope.daily))
    advanced(read_states(spark, params.week_state_path).where(weeks), before, after).write.parquet(path)
    states = spark.read.schema(STATE_SCHEMA).parquet(path)
    if consistent(states) and states.where(~weeks | F.isnull(weeks)).isEmpty():
        return True
    storage.delete(spark, path)
    return False
