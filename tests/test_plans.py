"""Plan-shape checks: the shuffles, broadcasts and pruning the design relies on."""

from __future__ import annotations

import datetime as dt
import re
import tempfile

from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.operators.compare import build_daily, build_daily_chained, ly_bridge_full
from shelfroll.operators.rollup import daily_agg, fact_rounded
from shelfroll.operators.weekly import AVERAGED, LAST_VALUE, SUMMED, build_weekly, build_weekly_joined
from shelfroll.plans import sinks
from shelfroll.sources.partitions import partition_list
from shelfroll.sources.tables import read_daily, read_staging

from .conftest import make_calendar, staging_rows


def _executed(df):
    return df._jdf.queryExecution().executedPlan()


def _plan(df) -> str:
    return _executed(df).toString()


def _stored_staging(spark):
    rows = [{"period_key": p, "total_units_ty": 1} for p in (19990106, 19990107, 20000105, 20000106)]
    path = tempfile.mkdtemp(prefix="plans-") + "/stg"
    sinks.write_staging(staging_rows(spark, rows), path, "full")
    return path


def _stored_calendar(spark):
    path = tempfile.mkdtemp(prefix="plans-") + "/cal"
    make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31)).write.parquet(path)
    return spark.read.schema(S.CALENDAR_SCHEMA).parquet(path)


def test_rounding_fits_methods_the_jvm_compiles(spark):
    """Generated methods of more than 8,000 bytes are never compiled: every row would be interpreted."""
    measures = ", ".join(f"{m.name} double" for m in S.METRICS)
    path = tempfile.mkdtemp(prefix="plans-") + "/fact"
    spark.createDataFrame([(1,) * 6 + (1.5,) * len(S.METRICS)], ", ".join(f"{k} int" for k in S.K6) + ", " + measures).write.parquet(path)
    fact = spark.read.parquet(path)
    fine = fact.select(*S.K6, *[(fact[m.name] * 0.123457).alias(m.name) for m in S.METRICS])
    rounded = fact_rounded(fine).select(*[F.col(m.name).cast("double").alias(m.name) for m in S.METRICS])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        for df in (daily_agg(fact), fact_rounded(fact), rounded):
            code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(_executed(df))
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", code)]
            assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_daily_short_form_exchanges_and_broadcast(spark):
    cal = _stored_calendar(spark)
    stg = read_staging(spark, _stored_staging(spark))
    joined = _plan(build_daily(stg, cal))
    assert joined.count("Exchange hashpartitioning") == 2
    assert "BroadcastExchange" in joined and "FullOuter" in joined
    aggregated = _plan(build_daily(stg, cal, strategy="aggregate"))
    assert aggregated.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in aggregated
    chained = _plan(build_daily_chained(stg, cal))
    assert chained.count("Exchange hashpartitioning") > joined.count("Exchange hashpartitioning")


def test_daily_range_prunes_both_sides(spark):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    stg = read_staging(spark, _stored_staging(spark))
    df = build_daily(stg, cal, 20000101, 20000131)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # TY scan filtered to the range, LY scan to the calendar's LY days of it
    assert "PartitionFilters: [isnotnull(period_key" in plan
    assert "20000101" in plan and "19990102" in plan
    assert {r[S.PERIOD] for r in df.collect()} == {20000105, 20000106}


def test_weekly_is_one_exchange_without_joins(spark):
    rows = [{"period_key": p, "total_units_ty": 1} for p in (20000105, 20000106)]
    path = tempfile.mkdtemp(prefix="plans-") + "/daily"
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    sinks.write_daily(build_daily(staging_rows(spark, rows), cal), path, "full")
    daily = read_daily(spark, path, 20000102, 20000108)
    plan = _plan(build_weekly(daily))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "PartitionFilters" in plan
    assert _plan(build_weekly_joined(daily, selfjoin=True)).count("Exchange") > 1


def test_metric_registry_partitions_weekly_treatments():
    names = [m.name for m in SUMMED + AVERAGED + LAST_VALUE]
    assert sorted(names) == sorted(m.name for m in S.METRICS)
    assert [m.name for m in AVERAGED] == ["osa_duration"]
    assert sorted(m.name for m in LAST_VALUE) == ["retail_on_hand", "rs_inventory"]
    assert len(S.DAILY_COLUMNS) == 24 and len(S.WEEKLY_COLUMNS) == 23 and len(S.STAGING_COLUMNS) == 17


def test_scan_reads_only_needed_columns(spark):
    df = read_staging(spark, _stored_staging(spark)).select(S.PERIOD, "total_units_ty")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<total_units_ty:double>" in plan


def test_calendar_broadcast_follows_the_planner(spark):
    cal = _stored_calendar(spark)
    stg = read_staging(spark, _stored_staging(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        df = build_daily(stg, cal)
        assert "BroadcastHashJoin" not in _plan(df)  # a calendar beyond the threshold is shuffled
        assert df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_salted_in_every_outer_join(spark):
    stg = read_staging(spark, _stored_staging(spark))
    cal = _stored_calendar(spark)
    for df in (ly_bridge_full(stg), build_daily_chained(stg, cal), build_daily(stg, cal)):
        outer = [line for line in _plan(df).splitlines() if "FullOuter" in line]
        assert outer and all("_null_key_salt" in line for line in outer)


def test_partition_listing_reads_no_file(spark):
    df = partition_list(spark, _stored_staging(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "parquet" not in plan.lower().replace("*.parquet", "")
    assert {(r[S.VENDOR], r[S.PERIOD]) for r in df.collect()} == {(1, p) for p in (19990106, 19990107, 20000105, 20000106)}


def test_month_slice_is_a_partition_filter(spark):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()["daily_period_slice"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in plan and "PartitionFilters: [period_key" in plan
