"""Whole-pipeline invariants on the smallest shared test tables."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.functions.strings import clean_list
from shelfroll.plans import pipeline
from shelfroll.sources import params

from .conftest import SF_SMALL


def test_pipeline_invariants(spark):
    stg = pipeline.staging(spark, SF_SMALL)
    daily = pipeline.daily(spark, SF_SMALL)
    weekly = pipeline.weekly(spark, SF_SMALL)
    # grain unique at every stage
    assert stg.groupBy(*S.K6).count().where("count > 1").count() == 0
    assert daily.groupBy(*S.K6).count().where("count > 1").count() == 0
    assert weekly.groupBy(*S.WEEK_KEYS).count().where("count > 1").count() == 0
    # every staging row is a TY value exactly once
    s_ty = stg.agg(F.sum(F.col("total_units_ty").cast("decimal(38,2)"))).first()[0]
    d_ty = daily.agg(F.sum(F.col("total_units_ty").cast("decimal(38,2)"))).first()[0]
    assert s_ty == d_ty
    # weekly sums equal daily sums, TY and LY
    for c in ("total_units_ty", "total_units_ly", "lost_sales_ty", "lost_sales_ly"):
        d = daily.agg(F.sum(F.col(c).cast("decimal(38,2)"))).first()[0]
        w = weekly.agg(F.sum(F.col(c).cast("decimal(38,2)"))).first()[0]
        assert d == w, c
    # LY on day d equals TY on LY(d) for the same entity
    t = stg.select(*[F.col(k).alias(f"s_{k}") for k in S.K5], F.col(S.PERIOD).alias("src_day"),
                   F.col("total_units_ty").alias("src"))
    cond = [F.col(k) == F.col(f"s_{k}") for k in S.K5] + [F.col(S.LY_PERIOD) == F.col("src_day")]
    ly = daily.where(F.col("total_units_ly") != 0).join(t, cond, "left")
    assert ly.count() > 0
    assert ly.where(F.col("src").isNull() | (F.col("src") != F.col("total_units_ly"))).count() == 0


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="ab, []\t", max_size=8), min_size=40, max_size=80))
def test_clean_list_column_matches_driver_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(clean_list("s")).collect()]
    assert got == [params.clean_list(v) for v in values]


# Expected sizes at sf0.001 from FIXTURES.md §3
# (rows, both TY and LY, LY only, TY only, null inventory) by total units.
EXPECTED_SF0001 = {
    "daily": (8382, 80, 2488, 5814, 0),
    "weekly": (7243, 468, 1858, 4917, 3499),
}


def test_fixture_sizes_match_expected(spark):
    for name, df in (("daily", pipeline.daily(spark, SF_SMALL)), ("weekly", pipeline.weekly(spark, SF_SMALL))):
        ty, ly = F.col("total_units_ty"), F.col("total_units_ly")
        r = df.agg(
            F.count("*"),
            F.sum(((ty != 0) & (ly != 0)).cast("int")),
            F.sum(((ty == 0) & (ly != 0)).cast("int")),
            F.sum(((ty != 0) & (ly == 0)).cast("int")),
            F.sum(F.col("rs_inventory_ty").isNull().cast("int")),
        ).first()
        assert tuple(r) == EXPECTED_SF0001[name], name
