"""Query registry: one entry per operator, each with its DuckDB oracle text.

Every query reads the shared test tables (through the stand-ins in
``sources.fixtures``) or datasets Spark wrote from them, over whole tables.
Every entry has an oracle; the job log's clock is pinned.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import dates as D
from ..functions import strings as STR
from ..operators.calendar import calendar_alias, calendar_window, period_between
from ..operators.compare import (
    build_daily,
    key_fallback,
    ly_bridge,
    ly_bridge_full,
    ly_shift,
    salted_outer_join,
    zero_fill,
)
from ..operators.lastvalue import (
    inventory_sorted,
    last_nonempty,
    last_nonempty_selfjoin,
    max_period_in_week,
    positive_rows,
)
from ..operators.rollup import build_staging, daily_agg, fact_rounded, group_agg
from ..operators.weekly import build_weekly, build_weekly_joined, weekly_agg, weekly_with_inventory
from ..operators.weekstate import advanced, week_states, weekly_from_states
from ..session import scratch_path
from ..sources import fixtures
from ..sources.counts import counting_session
from ..sources.counts import row_count as counts_of
from ..sources.params import JobParams
from ..sources.partitions import partition_list, partition_path, partition_slice, partitions_in_range
from ..sources.tables import (
    read_calendar,
    read_daily,
    read_dim_item,
    read_dim_osa_class,
    read_dim_store,
    read_fact,
    read_staging,
    read_weekly,
)
from . import oracle as O
from . import pipeline, sinks
from .runlog import latest_status, union_logs
from .stored import RETAILER, SUBJECT, stored

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle_sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, oracle_sql)
        return fn

    return deco


AS_OF_DATE = dt.date(O.AS_OF // 10000, (O.AS_OF // 100) % 100, O.AS_OF % 100)

# Ranges used by the range-scan / slice / upsert queries (the range is the
# operator under test; every query still reads whole tables).
STAGING_RANGE = (19970101, 19991231)
DAILY_RANGE = (20000101, 20001231)
SLICE_RANGE = (20000101, 20000131)
PATH_RANGE = (19980101, 19981231)
UPSERT_YEAR = 1999


def _window(spark: SparkSession, sf: str) -> DataFrame:
    return calendar_window(pipeline.calendar(spark, sf), O.AS_OF, O.YEARS)


def _daily_units_select(cols: list[str], src: str = "dly", where: str = "") -> str:
    return f"SELECT {', '.join(cols)} FROM {src} {where}"


STG_COLS = list(S.K6) + [O.metric_out(c) for c in S.TY_METRICS] + ["ly_period_key", "ty_year_week", "week_ended"]
DAILY_COLS = (
    ["retailer_key", "vendor_key", "period_key", "week_ended", "item_key", "store_key", "osa_type_key"]
    + [O.metric_out(c) for c in S.FINAL_METRICS]
    + ["ly_period_key"]
)
WEEKLY_COLS = list(S.WEEK_KEYS) + [O.metric_out(c, weekly=True) for c in S.FINAL_METRICS] + ["week_ended AS x_week_ended"]

# ================================================================ headline stages
query("daily_ty", O.staging_sql())(lambda spark, sf: pipeline.staging(spark, sf))
query("daily_ty_ly", O.daily_sql())(lambda spark, sf: pipeline.daily(spark, sf))
query("daily_ty_ly_chained", O.daily_sql())(lambda spark, sf: pipeline.daily(spark, sf, chained=True))
query("daily_ty_ly_union_aggregate", O.daily_sql())(
    lambda spark, sf: pipeline.daily(spark, sf, strategy="aggregate")
)
query("weekly_final", O.weekly_sql())(lambda spark, sf: pipeline.weekly(spark, sf))
query("weekly_final_joined", O.weekly_sql())(lambda spark, sf: pipeline.weekly(spark, sf, form="joined"))
query("weekly_final_selfjoin", O.weekly_sql())(lambda spark, sf: pipeline.weekly(spark, sf, form="selfjoin"))


@query(
    "daily_ty_ly_range",
    O.with_daily_range(SLICE_RANGE[0], SLICE_RANGE[1], _daily_units_select(DAILY_COLS)),
)
def daily_ty_ly_range(spark: SparkSession, sf: str) -> DataFrame:
    """TY days of one month with LY read from the calendar's LY days of that month."""
    return build_daily(pipeline.staging(spark, sf), _window(spark, sf), *SLICE_RANGE)


# ================================================================ scans (S2–S10)
@query("calendar_dim", f"SELECT * FROM ({fixtures.CALENDAR_SQL})")
def calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    return read_calendar(spark, stored(spark, sf, "dims"), RETAILER)


query("dim_item_scan", fixtures.DIM_ITEM_SQL)(lambda spark, sf: read_dim_item(spark, stored(spark, sf, "dims"), RETAILER))
query("dim_store_scan", fixtures.DIM_STORE_SQL)(lambda spark, sf: read_dim_store(spark, stored(spark, sf, "dims"), RETAILER))
query("dim_osa_class_scan", fixtures.DIM_OSA_CLASS_SQL)(
    lambda spark, sf: read_dim_osa_class(spark, stored(spark, sf, "dims"), RETAILER)
)
query("fact_scan", f"SELECT * FROM ({fixtures.FACT_SQL})")(lambda spark, sf: read_fact(spark, stored(spark, sf, "fact")))


@query(
    "staging_build",
    O.staging_sql(),
)
def staging_build(spark: SparkSession, sf: str) -> DataFrame:
    """Staging from the stored raw facts and the stored calendar (the job's inputs)."""
    fact = read_fact(spark, stored(spark, sf, "fact"))
    cal = read_calendar(spark, stored(spark, sf, "dims"), RETAILER)
    return build_staging(fact, cal)


query(
    "staging_range_scan",
    O.with_staging(_daily_units_select(STG_COLS, "stg", f"WHERE period_key BETWEEN {STAGING_RANGE[0]} AND {STAGING_RANGE[1]}")),
)(lambda spark, sf: read_staging(spark, stored(spark, sf, "staging"), *STAGING_RANGE))

query(
    "daily_range_scan",
    O.with_daily(_daily_units_select(DAILY_COLS, "dly", f"WHERE period_key BETWEEN {DAILY_RANGE[0]} AND {DAILY_RANGE[1]}")),
)(lambda spark, sf: read_daily(spark, stored(spark, sf, "daily"), *DAILY_RANGE))

query("partition_list", O.with_staging("SELECT DISTINCT vendor_key, period_key FROM stg"))(
    lambda spark, sf: partition_list(spark, stored(spark, sf, "staging"))
)


@query(
    "partition_in_range",
    O.with_staging(
        "SELECT partition_path FROM (SELECT DISTINCT 'vendor_key=' || vendor_key || '/period_key=' || period_key "
        "AS partition_path FROM stg) WHERE CAST(try_strptime(right(partition_path, 8), '%Y%m%d') AS DATE) "
        f"BETWEEN DATE '{PATH_RANGE[0] // 10000}-01-01' AND DATE '{PATH_RANGE[1] // 10000}-12-31'"
    ),
)
def partition_in_range(spark: SparkSession, sf: str) -> DataFrame:
    parts = partition_list(spark, stored(spark, sf, "staging")).select(partition_path().alias("partition_path"))
    return partitions_in_range(parts, "partition_path", *PATH_RANGE)


# ================================================================ sinks (T1–T7)
query("sink_staging_full", O.staging_sql())(lambda spark, sf: read_staging(spark, stored(spark, sf, "staging")))
query("sink_daily_full", O.daily_sql())(lambda spark, sf: read_daily(spark, stored(spark, sf, "daily")))
query("sink_weekly_full", O.weekly_sql())(lambda spark, sf: read_weekly(spark, stored(spark, sf, "weekly")))


def _upsert_round_trip(spark: SparkSession, df: DataFrame, write, read, measure: str, in_year) -> DataFrame:
    """Write the table with wrong values of vendor 1 in one year, upsert the true rows of that slice, read all back.

    Appending would leave the wrong rows beside the true ones, and overwriting
    everything would lose the other vendors and years.
    """
    path = scratch_path(spark, "upsert")
    slice_ = in_year & (F.col(S.VENDOR) == 1)
    wrong = df.withColumn(measure, F.when(slice_, F.col(measure) + 1000.0).otherwise(F.col(measure)))
    write(wrong, path, "full")
    write(df.where(slice_), path, "upsert")
    return read(spark, path)


@query("sink_staging_upsert", O.staging_sql())
def sink_staging_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Staging with one slice written wrongly, then replaced by an upsert."""
    df = read_staging(spark, stored(spark, sf, "staging"))
    in_year = F.floor(F.col(S.PERIOD) / 10000) == UPSERT_YEAR
    return _upsert_round_trip(spark, df, sinks.write_staging, read_staging, "total_units_ty", in_year)


@query("sink_daily_upsert", O.daily_sql())
def sink_daily_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Daily with one slice written wrongly, then replaced by an upsert."""
    df = read_daily(spark, stored(spark, sf, "daily"))
    in_year = F.floor(F.col(S.PERIOD) / 10000) == UPSERT_YEAR
    return _upsert_round_trip(spark, df, sinks.write_daily, read_daily, "total_units_ty", in_year)


@query("sink_weekly_upsert", O.weekly_sql())
def sink_weekly_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly with one slice written wrongly, then replaced by an upsert."""
    df = read_weekly(spark, stored(spark, sf, "weekly"))
    in_year = F.year(S.WEEK_ENDED) == UPSERT_YEAR
    return _upsert_round_trip(spark, df, sinks.write_weekly, read_weekly, "total_units_ty", in_year)


@query("weekly_state_upsert", O.weekly_sql())
def weekly_state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly from the states of a daily table with one slice wrong, after the slice's days were replaced by the true ones.

    The wrong days have other sums and no positive inventory, so sums, averages and last values must all follow.
    """
    true = read_daily(spark, stored(spark, sf, "daily"))
    slice_ = (F.floor(F.col(S.PERIOD) / 10000) == UPSERT_YEAR) & (F.col(S.VENDOR) == 1)
    mended = true.where(slice_)
    wrong = mended.withColumns(
        {"total_units_ty": F.col("total_units_ty") + 1000.0, "osa_duration_ly": F.lit(0.5), "rs_inventory_ty": F.lit(0.0)}
    )
    states = week_states(true.where(~slice_).unionByName(wrong))
    return weekly_from_states(advanced(states, wrong, mended))


#: range of the job queries: every fact day of the test tables
JOB_RANGE = (19950101, 20021231)
#: what the refresh and incremental jobs are run for
REFRESH_RANGE = (20000101, 20001231)
CHANGED_RANGE = (19990104, 19990110)
_JOB_CLOCK = dt.datetime(2001, 12, 31, 6, 0, 0)


def _job(spark: SparkSession, sf: str, load_type: str, bounds=JOB_RANGE, vendors=(0, 1, 2), fact: str | None = None, out: str | None = None) -> JobParams:
    dims = stored(spark, sf, "dims")
    # refreshes start from staging and read no facts: they get a base without any
    fact_dir = fact or (stored(spark, sf, "fact") if load_type in ("FL", "IL") else f"{dims}/{RETAILER}/{SUBJECT}/")
    osa_base = fact_dir.rstrip("/")[: -len(f"/{RETAILER}/{SUBJECT}")]
    return JobParams(
        aggregate_base_uri=out or scratch_path(spark, "job"),
        aggregation_level="StoreItem",
        aggregation_type="Day",
        retailer=RETAILER,
        vendors=list(vendors),
        job_id=1,
        fact_base_uri=osa_base,
        dim_base_uri=dims,
        calendar_id="c1",
        osa_fact_base_uri=osa_base,
        subject=SUBJECT,
        load_type=load_type,
        start=bounds[0],
        end=bounds[1],
    )


def _run(spark: SparkSession, params: JobParams) -> JobParams:
    from .jobs import run_job  # local import: jobs imports sinks/tables only

    run_job(spark, params, as_of=O.AS_OF, years=O.YEARS, clock=lambda: _JOB_CLOCK)
    return params


_JOBS: dict[tuple[str, str], JobParams] = {}
_JOBS_LOCK = threading.Lock()


def _full_load_job(spark: SparkSession, sf: str) -> JobParams:
    """One FL job run per (session, data folder), shared by the queries that only read its outputs."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    with _JOBS_LOCK:
        if key not in _JOBS:
            _JOBS[key] = _run(spark, _job(spark, sf, "FL"))
        return _JOBS[key]


@query("job_full_load", O.weekly_sql())
def job_full_load(spark: SparkSession, sf: str) -> DataFrame:
    """FL job over the stored facts (staging → daily → weekly); weekly read back."""
    params = _full_load_job(spark, sf)
    return read_weekly(spark, params.weekly_path)


@query("job_incremental_load", O.daily_sql())
def job_incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """FL over facts with one week of vendor 1 wrong, the true facts put in, IL for that week and vendor; daily read back.

    The week's own days and the days a year later that use them as last year
    must both follow; everything else must stay.
    """
    true = read_fact(spark, stored(spark, sf, "fact"))
    slice_ = F.col(S.PERIOD).between(*CHANGED_RANGE) & (F.col(S.VENDOR) == 1)
    fact = f"{scratch_path(spark, 'fact')}/{RETAILER}/{SUBJECT}/"
    sinks.write_partitioned(
        true.withColumn("total_units", F.when(slice_, F.col("total_units") + 7.0).otherwise(F.col("total_units"))), fact, S.DAILY_PARTITIONS, "full"
    )
    params = _run(spark, _job(spark, sf, "FL", fact=fact))
    sinks.write_partitioned(true.where(slice_), fact, S.DAILY_PARTITIONS, "upsert")
    _run(spark, _job(spark, sf, "IL", CHANGED_RANGE, (1,), fact, params.aggregate_base_uri))
    return read_daily(spark, params.daily_path)


def _copy_staging(spark: SparkSession, sf: str, params: JobParams) -> None:
    sinks.write_staging(read_staging(spark, stored(spark, sf, "staging")), params.staging_path, "full")


@query("job_full_refresh", O.with_daily_weeks(*REFRESH_RANGE, _daily_units_select(DAILY_COLS)))
def job_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """FR for one year over stored staging: daily holds the whole weeks of that year; read back."""
    params = _job(spark, sf, "FR", REFRESH_RANGE)
    _copy_staging(spark, sf, params)
    _run(spark, params)
    return read_daily(spark, params.daily_path)


@query("job_incremental_refresh", O.weekly_sql())
def job_incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Stored daily and weekly with one vendor's year wrong, mended by an IR from staging; weekly read back."""
    params = _job(spark, sf, "IR", REFRESH_RANGE, (1,))
    _copy_staging(spark, sf, params)
    year = REFRESH_RANGE[0] // 10000
    daily, weekly = read_daily(spark, stored(spark, sf, "daily")), read_weekly(spark, stored(spark, sf, "weekly"))
    wrong = lambda df, own: df.withColumn("lost_units_ty", F.when(own & (F.col(S.VENDOR) == 1), -1.0).otherwise(F.col("lost_units_ty")))
    sinks.write_daily(wrong(daily, F.col(S.PERIOD).between(*REFRESH_RANGE)), params.daily_path, "full")
    sinks.write_weekly(wrong(weekly, F.year(S.WEEK_ENDED) == year), params.weekly_path, "full")
    _run(spark, params)
    return read_weekly(spark, params.weekly_path)


@query("sink_job_log", O.job_log_sql(JOB_RANGE, _JOB_CLOCK))
def sink_job_log(spark: SparkSession, sf: str) -> DataFrame:
    """Run log (ORC) of an FL job over the stored facts, with each stage's row count; the clock is pinned."""
    params = _full_load_job(spark, sf)
    return spark.read.schema(S.JOB_LOG_SCHEMA).orc(params.log_path)


@query("job_step_status", O.job_status_sql(JOB_RANGE, _JOB_CLOCK))
def job_step_status(spark: SparkSession, sf: str) -> DataFrame:
    """The last step of every stage, read back from the log the FL job appended step by step."""
    params = _full_load_job(spark, sf)
    return latest_status(spark.read.schema(S.JOB_LOG_SCHEMA).orc(params.log_path))


# ================================================================ projections / filters
@query(
    "fact_rounded",
    f"WITH fact AS ({fixtures.FACT_SQL}) SELECT {', '.join(S.K6)}, "
    + ", ".join(f"CAST(round(CAST({m.name} AS DECIMAL(28,8)), 2) AS DOUBLE) AS {m.name}" for m in S.METRICS)
    + " FROM fact",
)
def fact_rounded_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every fact measure rounded HALF_UP to cents."""
    r = fact_rounded(pipeline.fact(spark, sf))
    return r.select(*S.K6, *[F.col(m.name).cast("double").alias(m.name) for m in S.METRICS])


#: a factor with six decimals: the measures then have six and more
FINE_FACTOR = 0.123457


@query(
    "fact_rounded_fine",
    f"WITH fact AS ({fixtures.FACT_SQL}) SELECT {', '.join(S.K6)}, "
    + ", ".join(f"CAST(round(CAST({m.name} * CAST({FINE_FACTOR} AS DOUBLE) AS DECIMAL(28,8)), 2) AS DOUBLE) AS {m.name}" for m in S.METRICS)
    + " FROM fact",
)
def fact_rounded_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Measures with six and more decimals, rounded once, HALF_UP, to cents."""
    fine = pipeline.fact(spark, sf).select(*S.K6, *[(F.col(m.name) * F.lit(FINE_FACTOR)).alias(m.name) for m in S.METRICS])
    r = fact_rounded(fine)
    return r.select(*S.K6, *[F.col(m.name).cast("double").alias(m.name) for m in S.METRICS])


query(
    "ly_bridge",
    O.with_staging("SELECT retailer_key, vendor_key, ly_period_key AS period_key, item_key, store_key, osa_type_key FROM stg"),
)(lambda spark, sf: ly_bridge(pipeline.staging(spark, sf)))

query("ly_bridge_full", O.with_chained(O.LY_BRIDGE_FULL_SELECT))(lambda spark, sf: ly_bridge_full(pipeline.staging_once(spark, sf)))

query("zero_fill", O.with_chained(O.LY_BRIDGE_FULL_ZERO_SELECT))(
    lambda spark, sf: zero_fill(ly_bridge_full(pipeline.staging_once(spark, sf)), S.LY_METRICS)
)


@query("key_fallback", O.with_chained(O.KEY_FALLBACK_SELECT))
def key_fallback_q(spark: SparkSession, sf: str) -> DataFrame:
    """Chained TY ⟗ LY keys: blank/null TY day and week fall back to the calendar's."""
    stg = pipeline.staging_once(spark, sf)
    ly = ly_bridge_full(stg).join(calendar_alias(_window(spark, sf)), S.LY_PERIOD, "inner")
    ty = stg.select(*S.K6, S.WEEK_ENDED, S.LY_PERIOD)
    j = salted_outer_join(ty, ly.select(S.LY_PERIOD, *S.K5, "x_period_key", S.X_WEEK_ENDED), [S.LY_PERIOD] + S.K5)
    return j.select(
        *S.K5,
        S.LY_PERIOD,
        key_fallback(S.PERIOD, "x_period_key").alias("period_text"),
        key_fallback(S.WEEK_ENDED, S.X_WEEK_ENDED).alias("week_text"),
    )


query("calendar_window", f"WITH cal AS ({fixtures.CALENDAR_SQL}), {O.window_cte()} SELECT * FROM calw")(
    lambda spark, sf: _window(spark, sf)
)

query(
    "ly_shift",
    O.with_daily(
        "SELECT "
        + ", ".join(
            ["retailer_key", "vendor_key", "period_key", "item_key", "store_key", "osa_type_key", "week_ended", "ly_period_key"]
            + [O.metric_out(c) for c in S.LY_METRICS]
        )
        + " FROM ly"
    ),
)(lambda spark, sf: ly_shift(pipeline.staging(spark, sf), _window(spark, sf)))

query(
    "positive_inventory",
    O.with_daily(
        "SELECT retailer_key, vendor_key, item_key, store_key, osa_type_key, week_ended, period_key, "
        f"{O.metric_out('rs_inventory_ty')}, {O.metric_out('rs_inventory_ly')} FROM dly WHERE rs_inventory_ty > 0"
    ),
)(lambda spark, sf: positive_rows(pipeline.daily(spark, sf), "rs_inventory"))


@query(
    "daily_period_slice",
    O.with_daily(_daily_units_select(DAILY_COLS, "dly", f"WHERE period_key BETWEEN {SLICE_RANGE[0]} AND {SLICE_RANGE[1]}")),
)
def daily_period_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The stored daily partitions of one month's calendar days (an upsert's slice): a partition filter on the scan."""
    days = pipeline.calendar(spark, sf).where(period_between(*SLICE_RANGE)).select(S.PERIOD).collect()
    return partition_slice(read_daily(spark, stored(spark, sf, "daily")), S.PERIOD, sorted(r[0] for r in days))


# ================================================================ aggregations
@query(
    "daily_agg",
    O.with_staging("SELECT " + ", ".join(list(S.K6) + [O.metric_out_as(m.ty, m.name) for m in S.METRICS]) + " FROM agg"),
)
def daily_agg_q(spark: SparkSession, sf: str) -> DataFrame:
    return daily_agg(pipeline.fact(spark, sf))


@query("group_agg_generic", O.GROUP_AGG_SQL)
def group_agg_generic(spark: SparkSession, sf: str) -> DataFrame:
    g = group_agg(
        fact_rounded(pipeline.fact(spark, sf)),
        [S.VENDOR, S.OSA_TYPE],
        [
            ("total_units", "sum", "sum_total_units"),
            ("osa_duration", "avg", "avg_osa_duration"),
            (S.PERIOD, "min", "first_period"),
            (S.PERIOD, "max", "last_period"),
            ("total_sales", "count", "n_sales"),
        ],
    )
    return g.select(
        S.VENDOR,
        S.OSA_TYPE,
        F.col("sum_total_units").cast("double").alias("sum_total_units"),
        F.col("avg_osa_duration").cast("double").alias("avg_osa_duration"),
        "first_period",
        "last_period",
        "n_sales",
    )


WEEKLY_AGG_COLS = list(S.WEEK_KEYS) + [
    O.metric_out(c, weekly=True)
    for m in S.METRICS
    if m.weekly in ("sum", "avg")
    for c in (m.ty, m.ly)
]
query("weekly_agg", O.with_weekly(f"SELECT {', '.join(WEEKLY_AGG_COLS)} FROM wk"))(
    lambda spark, sf: weekly_agg(pipeline.daily(spark, sf))
)

query(
    "weekly_join_inventory",
    O.with_weekly(
        f"SELECT {', '.join(WEEKLY_AGG_COLS)}, {O.metric_out('rs_inventory_ty', True)}, "
        f"{O.metric_out('rs_inventory_ly', True)} FROM wk"
    ),
)(lambda spark, sf: weekly_with_inventory(pipeline.daily(spark, sf), ["rs_inventory"]))

query(
    "max_period_in_week",
    O.with_daily(
        "SELECT retailer_key, vendor_key, item_key, store_key, osa_type_key, week_ended, max(period_key) AS period_key "
        "FROM dly WHERE rs_inventory_ty > 0 GROUP BY ALL"
    ),
)(lambda spark, sf: max_period_in_week(pipeline.daily(spark, sf), "rs_inventory"))


def _last_sql(metric: str) -> str:
    ty, ly = f"{metric}_ty", f"{metric}_ly"
    return O.with_daily(
        f"SELECT {O.WK}, {O.metric_out(ty, True)}, {O.metric_out(ly, True)} FROM ("
        f"SELECT {O.WK}, arg_max({ty}, period_key) FILTER (WHERE {ty} > 0) AS {ty}, "
        f"arg_max({ly}, period_key) FILTER (WHERE {ty} > 0) AS {ly} FROM dly GROUP BY {O.WK}) WHERE {ty} IS NOT NULL"
    )


query("last_nonempty_inventory", _last_sql("rs_inventory"))(
    lambda spark, sf: last_nonempty(pipeline.daily(spark, sf), "rs_inventory")
)
query("last_nonempty_on_hand", _last_sql("retail_on_hand"))(
    lambda spark, sf: last_nonempty(pipeline.daily(spark, sf), "retail_on_hand")
)
query("last_nonempty_selfjoin", _last_sql("rs_inventory"))(
    lambda spark, sf: last_nonempty_selfjoin(pipeline.daily(spark, sf), "rs_inventory")
)

query("distinct_vendor_week", O.with_daily("SELECT DISTINCT vendor_key, week_ended FROM dly"))(
    lambda spark, sf: pipeline.weekly(spark, sf).select(S.VENDOR, S.WEEK_ENDED).distinct()
)


#: stored stages: name, layout, partition columns
STAGES = [
    ("staging", S.STAGING_SCHEMA, S.DAILY_PARTITIONS),
    ("daily", S.DAILY_SCHEMA, S.DAILY_PARTITIONS),
    ("weekly", S.WEEKLY_SCHEMA, S.WEEKLY_PARTITIONS),
]


@query(
    "row_count",
    O.with_weekly(
        "SELECT 'staging' AS table_name, count(*) AS row_count FROM stg UNION ALL "
        "SELECT 'daily', count(*) FROM dly UNION ALL SELECT 'weekly', count(*) FROM wk"
    ),
)
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the three stored stages, counted in their Parquet footers."""
    session = counting_session(spark)
    counts = [(name, counts_of(session, stored(spark, sf, name), schema)) for name, schema, _ in STAGES]
    return union_logs([c.select(F.lit(name).alias("table_name"), "row_count") for name, c in counts])


# ================================================================ sort / limit / union
query(
    "inventory_sorted",
    O.with_daily(
        "SELECT retailer_key, vendor_key, item_key, store_key, osa_type_key, week_ended, period_key, "
        f"{O.metric_out('rs_inventory_ty')}, {O.metric_out('rs_inventory_ly')} FROM dly WHERE rs_inventory_ty > 0 "
        "ORDER BY item_key, store_key, osa_type_key, week_ended, period_key"
    ),
)(lambda spark, sf: inventory_sorted(pipeline.daily(spark, sf), "rs_inventory"))

PREVIEW_ROWS = 20
query(
    "daily_preview",
    O.with_daily(_daily_units_select(DAILY_COLS, "dly", f"ORDER BY {O.K6} LIMIT {PREVIEW_ROWS}")),
)(lambda spark, sf: sinks.preview(pipeline.daily(spark, sf), S.K6, PREVIEW_ROWS))


@query(
    "job_log_union",
    O.with_weekly(
        " UNION ALL ".join(
            f"SELECT CAST(vendor_key AS INTEGER) AS JobId, '{step}' AS JobStep, 'rows=' || count(*) AS JobDescription, "
            f"CAST(NULL AS VARCHAR) AS StartTime, 'Success' AS Status FROM {src} GROUP BY vendor_key"
            for step, src in (("staging", "stg"), ("daily", "dly"), ("weekly", "wk"))
        )
    ),
)
def job_log_union(spark: SparkSession, sf: str) -> DataFrame:
    """Per-vendor row counts of the three stages (directory counts from footers) as log rows, combined by bag union."""
    session = counting_session(spark)
    frames = []
    for step, schema, parts in STAGES:
        per = counts_of(session, stored(spark, sf, step), schema, parts)
        frames.append(
            per.groupBy(S.VENDOR)
            .agg(F.sum("row_count").alias("n"))
            .select(
                F.col(S.VENDOR).cast("int").alias("JobId"),
                F.lit(step).alias("JobStep"),
                F.concat(F.lit("rows="), F.col("n").cast("string")).alias("JobDescription"),
                F.lit(None).cast("string").alias("StartTime"),
                F.lit("Success").alias("Status"),
            )
        )
    return union_logs(frames)


# ================================================================ scalar functions
def _part(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "part")


query(
    "str_sentence_case",
    "SELECT p_partkey, upper(left(lower(p_type || ' ' || p_name), 1)) || substr(lower(p_type || ' ' || p_name), 2) AS value FROM part",
)(
    lambda spark, sf: _part(spark, sf).select(
        "p_partkey", STR.sentence_case(F.concat_ws(" ", "p_type", "p_name")).alias("value")
    )
)
query("str_upper", "SELECT p_partkey, upper(p_name) AS value FROM part")(
    lambda spark, sf: _part(spark, sf).select("p_partkey", STR.upper_case("p_name").alias("value"))
)
query(
    "str_strip_brackets",
    "SELECT p_partkey, replace(replace('[' || p_name || '] [' || p_brand || ']', '[', ''), ']', '') AS value FROM part",
)(
    lambda spark, sf: _part(spark, sf).select(
        "p_partkey",
        STR.strip_brackets(F.concat(F.lit("["), "p_name", F.lit("] ["), "p_brand", F.lit("]"))).alias("value"),
    )
)
query(
    "str_case_or_message",
    "SELECT p_partkey, CASE WHEN length(s) > 0 THEN upper(left(lower(s), 1)) || substr(lower(s), 2) "
    f"ELSE '{STR.EMPTY_ARGUMENT_MESSAGE}' END AS value "
    "FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN '' ELSE p_name END AS s FROM part)",
)(
    lambda spark, sf: _part(spark, sf).select(
        "p_partkey",
        STR.case_or_message(F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.col("p_name"))).alias("value"),
    )
)
query("str_replace_char", "SELECT p_partkey, replace(p_brand, '#', ' ') AS value FROM part")(
    lambda spark, sf: _part(spark, sf).select("p_partkey", STR.replace_char("p_brand", "#").alias("value"))
)


@query(
    "str_clean_list",
    "SELECT p_partkey, unnest(generate_series(0, len(arr) - 1)) AS pos, unnest(arr) AS item FROM ("
    "SELECT p_partkey, CASE WHEN regexp_full_match(c, ',+') THEN CAST([] AS VARCHAR[]) "
    "ELSE string_split(regexp_replace(c, ',+$', ''), ',') END AS arr FROM ("
    "SELECT p_partkey, regexp_replace('[' || replace(p_name, ' ', ', ') || ', ]', '[\\[\\]\\s]', '', 'g') AS c "
    "FROM part))",
)
def str_clean_list(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("["), F.regexp_replace("p_name", " ", ", "), F.lit(", ]"))
    arr = _part(spark, sf).select("p_partkey", STR.clean_list(text).alias("arr"))
    return arr.select("p_partkey", F.posexplode("arr").alias("pos", "item"))


query(
    "date_relative",
    "SELECT d AS as_of, strftime(d, '%Y-%m-%d') AS today, strftime(d - 1, '%Y-%m-%d') AS yesterday, "
    "strftime(d - 30, '%Y-%m-%d') AS days_ago_30, CAST(year(d) AS INTEGER) AS current_year "
    "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)",
)(
    lambda spark, sf: fixtures.table(spark, sf, "orders")
    .select(F.to_date("o_orderdate").alias("as_of"))
    .distinct()
    .select(
        "as_of",
        D.today(F.col("as_of")).alias("today"),
        D.yesterday(F.col("as_of")).alias("yesterday"),
        D.days_ago(F.col("as_of"), 30).alias("days_ago_30"),
        D.current_year(F.col("as_of")).alias("current_year"),
    )
)
query(
    "date_key_format",
    "SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS period_text FROM lineitem",
)(
    lambda spark, sf: fixtures.table(spark, sf, "lineitem")
    .select(F.to_date("l_shipdate").alias("d"))
    .distinct()
    .select("d", D.to_period_key(F.col("d")).alias("period_text"))
)

_KEY_INPUTS_SQL = (
    "SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS k FROM lineitem"
)


@query(
    "date_key_parse",
    "WITH k AS (" + _KEY_INPUTS_SQL + "), s AS ("
    "SELECT k AS s FROM k UNION ALL SELECT substr(k, 1, 4) || '13' || substr(k, 7, 2) FROM k "
    "UNION ALL SELECT substr(k, 1, 6) || '32' FROM k UNION ALL SELECT 'x' || substr(k, 2) FROM k "
    "UNION ALL SELECT substr(k, 1, 4) || '0230' FROM k) "
    "SELECT s, CAST(try_strptime(s, '%Y%m%d') AS DATE) AS parsed FROM s",
)
def date_key_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = fixtures.table(spark, sf, "lineitem").select(D.to_period_key(F.to_date("l_shipdate")).alias("k")).distinct()
    variants = [
        F.col("k"),
        F.concat(F.substring("k", 1, 4), F.lit("13"), F.substring("k", 7, 2)),
        F.concat(F.substring("k", 1, 6), F.lit("32")),
        F.concat(F.lit("x"), F.substr(F.col("k"), F.lit(2))),
        F.concat(F.substring("k", 1, 4), F.lit("0230")),
    ]
    s = union_logs([k.select(v.alias("s")) for v in variants])
    return s.select("s", D.parse_period_key("s").alias("parsed"))


query(
    "run_timestamp",
    "SELECT DISTINCT l_shipdate AS ts, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM lineitem",
)(
    lambda spark, sf: fixtures.table(spark, sf, "lineitem")
    .select(F.col("l_shipdate").alias("ts"))
    .distinct()
    .select("ts", D.run_timestamp("ts").alias("stamp"))
)


@query(
    "date_day_of_week",
    "WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), s AS ("
    "SELECT strftime(d, '%Y-%m-%d') AS s FROM d UNION ALL SELECT strftime(d, '%Y/%m/%d') FROM d "
    "UNION ALL SELECT CAST(NULL AS VARCHAR) FROM (SELECT DISTINCT o_orderstatus FROM orders) "
    "UNION ALL SELECT strftime(d, '%Y-%m-') || '32' FROM d) "
    f"SELECT s, CASE WHEN s IS NULL THEN dayname(DATE '{AS_OF_DATE.isoformat()}') "
    "ELSE dayname(try_strptime(replace(s, '-', '/'), '%Y/%m/%d')) END AS day_name FROM s",
)
def date_day_of_week(spark: SparkSession, sf: str) -> DataFrame:
    orders = fixtures.table(spark, sf, "orders")
    d = orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    s = union_logs(
        [
            d.select(F.date_format("d", "yyyy-MM-dd").alias("s")),
            d.select(F.date_format("d", "yyyy/MM/dd").alias("s")),
            orders.select("o_orderstatus").distinct().select(F.lit(None).cast("string").alias("s")),
            d.select(F.concat(F.date_format("d", "yyyy-MM-"), F.lit("32")).alias("s")),
        ]
    )
    return s.select("s", D.day_of_week("s", AS_OF_DATE).alias("day_name"))
