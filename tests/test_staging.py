from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.functions.numeric import round_half_up
from shelfroll.operators.rollup import build_staging, daily_agg, fact_rounded, flagged_staging, group_agg

from .conftest import make_calendar


def _fact(spark, rows):
    full = []
    for r in rows:
        keys = [r.get(k, 1) for k in S.K6]
        full.append(tuple(keys + [r.get(m.name) for m in S.METRICS]))
    return spark.createDataFrame(full, S.FACT_SCHEMA)


def test_round_half_up_is_exact_for_binary_doubles(spark):
    # 1.005 and 2.675 are below the half point in binary; decimal rounding still goes up
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.125,), (-0.0,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2).cast("double")).collect()]
    assert got == [1.01, 2.68, -0.13, 0.0]


def test_daily_agg_sums_and_averages_repeated_grain(spark):
    fact = _fact(
        spark,
        [
            {"period_key": 20000103, "total_units": 1.004, "osa_duration": 1.0},
            {"period_key": 20000103, "total_units": 2.0, "osa_duration": 2.0},
            {"period_key": 20000103, "total_units": None, "osa_duration": 2.5},
            {"period_key": 20000104, "total_units": 5.0, "osa_duration": None},
        ],
    )
    got = {r[S.PERIOD]: r for r in daily_agg(fact).collect()}
    assert got[20000103]["total_units"] == 3.0
    assert got[20000103]["osa_duration"] == round((1.0 + 2.0 + 2.5) / 3, 6)
    assert got[20000104]["osa_duration"] is None
    assert got[20000104]["total_units"] == 5.0


def test_staging_joins_calendar_and_counts_dropped_days(spark):
    cal = make_calendar(spark, dt.date(2000, 1, 1), dt.date(2000, 1, 31))
    fact = _fact(
        spark,
        [
            {"period_key": 20000103, "total_units": 1.0},
            {"period_key": 20000301, "total_units": 1.0},  # off the calendar
            {"period_key": 20000301, "vendor_key": 2, "total_units": 1.0},
        ],
    )
    stg = build_staging(fact, cal)
    rows = stg.collect()
    assert len(rows) == 1
    flagged = flagged_staging(fact, cal)
    assert flagged.where("not on_calendar").count() == 2
    assert flagged.where("on_calendar").drop("on_calendar").collect() == rows
    r = rows[0]
    assert r[S.LY_PERIOD] == 19990104
    assert r[S.WEEK_ENDED] == dt.date(2000, 1, 8)
    assert stg.columns == S.STAGING_COLUMNS


def test_group_agg_explicit_aliases(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 1.0)], "k int, v double")
    out = {r.k: r for r in group_agg(df, ["k"], [("v", "sum", "s"), ("v", "avg", "a"), ("v", "count", "n")]).collect()}
    assert out[1].s == 6.0 and out[1].a == 3.0 and out[1].n == 2
    try:
        group_agg(df, ["k"], [("v", "median", "m")])
    except ValueError:
        pass
    else:
        raise AssertionError("unknown aggregate must raise")


def test_fact_rounded_keeps_grain(spark):
    fact = _fact(spark, [{"period_key": 20000103, "total_units": 1.0}] * 3)
    assert fact_rounded(fact).count() == 3
    assert fact_rounded(fact).agg(F.sum("total_units")).first()[0] == 3
