"""Counts come from Parquet footers and equal the rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.plans import sinks
from shelfroll.sources.counts import counting_session, row_count

from .conftest import staging_rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(spark):
    rows = [{"vendor_key": v, "period_key": 20000103 + d, "item_key": i} for v in (1, 2) for d in range(4) for i in range(1 + v * d)]
    path = tempfile.mkdtemp(prefix="counts-") + "/stg"
    df = staging_rows(spark, rows)
    sinks.write_staging(df, path, "full")
    return path, df


def test_counts_read_no_row(spark):
    path, df = _stored(spark)
    session = counting_session(spark)
    one = row_count(session, path, S.STAGING_SCHEMA)
    assert "PushedAggregation: [COUNT(*)]" in _plan(one) and "PushedGroupBy: []" in _plan(one)
    assert [r.row_count for r in one.collect()] == [df.count()]
    per = row_count(session, path, S.STAGING_SCHEMA, S.DAILY_PARTITIONS)
    assert "PushedAggregation: [COUNT(*)]" in _plan(per) and "PushedGroupBy: [vendor_key, period_key]" in _plan(per)
    want = {(r[0], r[1]): r[2] for r in df.groupBy(*S.DAILY_PARTITIONS).agg(F.count("*")).collect()}
    assert {(r[0], r[1]): r[2] for r in per.collect()} == want


def test_the_callers_session_stays_as_it_is(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    counting_session(spark)
    assert before == {name: spark.conf.get(name) for name in before}


def test_an_empty_dataset_counts_nought(spark):
    path = tempfile.mkdtemp(prefix="counts-") + "/stg"
    sinks.write_staging(staging_rows(spark, [{"period_key": 20000103}]).limit(0), path, "full")
    assert [r.row_count for r in row_count(counting_session(spark), path, S.STAGING_SCHEMA).collect()] == [0]
