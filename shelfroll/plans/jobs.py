"""Job runner: load-type dispatch over the three stages.

=====  ========  ======================  ===========================================
type   staging   daily / weekly write    daily / weekly content
=====  ========  ======================  ===========================================
FL     upsert    full overwrite          all vendors, whole weeks of the range
IL     upsert    upsert                  job vendors, days in range + their LY users
FR     skipped   full overwrite          all vendors, whole weeks of the range
IR     skipped   upsert                  job vendors, days in range + their LY users
=====  ========  ======================  ===========================================

Each stage is one set-based Spark job over all requested vendors and
periods (no per-partition driver loop). What each stage loads follows from the
range through the calendar (``scope.py``) and is settled before anything is
written: a full load stages the whole weeks of its range and their LY days, so
no week is built from part of its days where the facts hold the others.

A stage answers for its vendors and days: stored partitions of these that it
has no rows for any more are removed (a fact day that vanished leaves no row
in staging, daily or weekly); everything else keeps its files. Daily success
gates weekly. Errors propagate; every step is appended to the run log (ORC,
under the job's output folder) when it happens, so a job that is killed in a
stage leaves that stage's In-Progress row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.calendar import as_key, calendar_window, week_bounds
from ..operators.compare import build_daily
from ..operators.rollup import flagged_staging
from ..operators.weekstate import STATE_SCHEMA, week_states, weekly_from_states
from ..session import scratch_path
from ..sources import storage
from ..sources.params import JobParams, JobParamsError, read_params
from ..sources.tables import read_calendar, read_daily, read_fact, read_staging
from . import sinks, weekstates
from .runlog import FAILED, IN_PROGRESS, SUCCESS, RunLog
from .scope import JobScope, job_scope, within


@dataclass(frozen=True)
class LoadPlan:
    build_staging: bool
    final_mode: str  # "full" | "upsert"


# What each load type does.
LOAD_PLANS = {
    "FL": LoadPlan(build_staging=True, final_mode="full"),
    "IL": LoadPlan(build_staging=True, final_mode="upsert"),
    "FR": LoadPlan(build_staging=False, final_mode="full"),
    "IR": LoadPlan(build_staging=False, final_mode="upsert"),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _removed(written: sinks.Written, why: str) -> str:
    return f"; {written.removed} partition(s) without {why} removed" if written.removed else ""


def _load_staging(spark: SparkSession, params: JobParams, calendar: DataFrame, scope: JobScope, log: RunLog) -> None:
    log.add("Staging started", IN_PROGRESS)
    fact = read_fact(spark, params.fact_path, params.vendors).where(within(scope.staging))
    own = sinks.vendor_scope(params.vendors) & within([scope.own])
    with sinks.spooled(flagged_staging(fact, calendar)) as rows:
        off = rows.where(~F.col("on_calendar") & within([scope.own])).count()
        staged = rows.where("on_calendar").select(*S.STAGING_COLUMNS)
        done = sinks.write_rows(staged, params.staging_path, S.DAILY_PARTITIONS, "upsert", own)
    log.add(
        f"Staging loaded for vendors {params.vendors}: {done.rows} rows; "
        f"{off} daily rows had no calendar day{_removed(done, 'facts')}"
    )


def _load_daily(
    spark: SparkSession, params: JobParams, window: DataFrame, calendar: DataFrame, scope: JobScope, mode: str, log: RunLog, states: str
) -> bool:
    """True where the states of the job's weeks were made from the changed days; they are then at ``states``.

    A full load replaces daily, so the rows it writes are all rows of its weeks: its states are made from them too,
    before they are dealt to thousands of files."""
    log.add(f"Daily {mode} started", IN_PROGRESS)
    # upserts rebuild only the job's vendors (other vendors' partitions are
    # untouched); full loads replace the dataset and so cover every vendor
    vendors = params.vendors if mode == "upsert" else None
    staging = read_staging(spark, params.staging_path, vendors=vendors)
    daily = _union([build_daily(staging, window, lo, hi) for lo, hi in scope.daily])
    own = sinks.vendor_scope(vendors) & within(scope.daily) if mode == "upsert" else None
    weekstates.begin(spark, params.week_state_path)
    follows = mode == "upsert" and weekstates.covered(spark, params, calendar, scope)
    with sinks.spooled(daily.select(*S.DAILY_COLUMNS)) as rows:
        if follows:
            follows = weekstates.follow(spark, params, scope, _own_weeks(params, calendar, scope), rows, states)
        elif mode == "full":
            week_states(rows.where(within(scope.weeks))).write.parquet(states)
        done = sinks.write_rows(rows, params.daily_path, S.DAILY_PARTITIONS, mode, own)
    log.add(f"Daily {mode} done for {scope.daily}: {done.rows} rows{_removed(done, 'rows')}")
    return follows


def _own_weeks(params: JobParams, calendar: DataFrame, scope: JobScope) -> Column:
    """The job's vendors and weeks."""
    bounds = [week_bounds(calendar, lo, hi) for lo, hi in scope.weeks]
    return sinks.vendor_scope(params.vendors) & _any([F.col(S.WEEK_ENDED).between(F.lit(lo), F.lit(hi)) for lo, hi in bounds])


def _load_weekly(
    spark: SparkSession, params: JobParams, calendar: DataFrame, scope: JobScope, mode: str, log: RunLog, states: str, follows: bool
) -> None:
    """States first, then weekly from them. ``states`` has them already after a full load, and where ``follows`` is true,
    from the changed days; otherwise they are made from whole weeks of the daily table."""
    log.add(f"Weekly {mode} started", IN_PROGRESS)
    if mode == "upsert" and not follows:
        daily = read_daily(spark, params.daily_path, vendors=params.vendors).where(within(scope.weeks))
        week_states(daily).write.parquet(states)
    rows = spark.read.schema(STATE_SCHEMA).parquet(states)
    own = _own_weeks(params, calendar, scope) if mode == "upsert" else None
    sinks.write_rows(rows, params.week_state_path, S.WEEKLY_PARTITIONS, mode, own)
    weekly = weekly_from_states(rows).select(*S.WEEKLY_COLUMNS)
    done = sinks.write_rows(weekly, params.weekly_path, S.WEEKLY_PARTITIONS, mode, own)
    weekstates.end(spark, params.week_state_path)
    how = ", from the changed days" if follows else ""
    log.add(f"Weekly {mode} done for {scope.weeks}{how}: {done.rows} rows{_removed(done, 'rows')}", SUCCESS)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def run_job(
    spark: SparkSession,
    params: JobParams,
    as_of: int | str | dt.date | None = None,
    years: int = 3,
    clock=None,
) -> RunLog:
    """Run one job; returns the run log (each step also appended to ``params.log_path``)."""
    log = RunLog(params.job_id, clock=clock, keep=lambda rows: sinks.append_job_log(rows.to_df(spark), params.log_path))
    log.add(
        f"Parameters checked: load type {params.load_type}, vendors {params.vendors}, "
        f"range {params.start}..{params.end}"
    )
    plan = LOAD_PLANS[params.load_type]
    as_of = as_key(as_of if as_of is not None else dt.date.today())
    try:
        calendar = read_calendar(spark, params.dim_base, params.retailer)
        scope = job_scope(calendar, params.start, params.end, plan.final_mode == "upsert")
        if plan.build_staging:
            _load_staging(spark, params, calendar, scope, log)
        else:
            log.add("Staging not required; refreshing daily and weekly", IN_PROGRESS)
        window = calendar_window(calendar, as_of, years)
        states = scratch_path(spark, "week-states")
        try:
            follows = _load_daily(spark, params, window, calendar, scope, plan.final_mode, log, states)
            _load_weekly(spark, params, calendar, scope, plan.final_mode, log, states, follows)
        finally:
            storage.delete(spark, states)
    except Exception as e:  # record, then re-raise
        log.add(f"{type(e).__name__}: {e}", FAILED)
        raise
    return log


def run_from_file(
    spark: SparkSession,
    params_path: str,
    as_of=None,
    years: int = 3,
    log_path: str | None = None,
    clock=None,
) -> RunLog:
    """Read the JSON parameters, then :func:`run_job`.

    Invalid parameters (wrong field count, several objects, unknown load
    type, bad date range) raise :class:`JobParamsError` after a Failed step
    was appended to ``log_path`` or, by default, to the job's own log folder
    as far as the document names one.
    """
    try:
        params = read_params(spark, params_path)
    except JobParamsError as e:
        where = log_path or e.log_path
        if where is not None:
            log = RunLog(None, clock=clock, keep=lambda rows: sinks.append_job_log(rows.to_df(spark), where))
            log.add(f"Parameter file {params_path} rejected: {e}", FAILED)
        raise
    return run_job(spark, params, as_of=as_of, years=years, clock=clock)
