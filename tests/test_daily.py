from __future__ import annotations

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.operators.compare import build_daily, build_daily_chained, key_fallback, ly_shift

from .conftest import key, make_calendar, staging_rows


def _by_key(df):
    return {(r[S.PERIOD], r[S.ITEM], r[S.STORE], r[S.VENDOR]): r for r in df.collect()}


def test_ty_ly_basic_match_and_one_sided_rows(spark):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    stg = staging_rows(
        spark,
        [
            {"period_key": 20000105, "total_units_ty": 5},  # TY with LY partner
            {"period_key": 19990106, "total_units_ty": 3},  # its LY day (2000-01-05 - 364)
            {"period_key": 19990107, "total_units_ty": 7},  # LY only for 2000-01-06
        ],
    )
    out = _by_key(build_daily(stg, cal))
    r = out[(20000105, 1, 1, 1)]
    assert (r["total_units_ty"], r["total_units_ly"], r[S.LY_PERIOD]) == (5.0, 3.0, 19990106)
    lyonly = out[(20000106, 1, 1, 1)]
    assert (lyonly["total_units_ty"], lyonly["total_units_ly"]) == (0.0, 7.0)
    assert lyonly[S.WEEK_ENDED] == dt.date(2000, 1, 8)
    assert lyonly[S.LY_PERIOD] == 19990107
    # TY rows of 1999 have no LY (calendar starts 1999) but stay
    assert out[(19990106, 1, 1, 1)]["total_units_ly"] == 0.0
    assert all(c in out[(19990106, 1, 1, 1)].asDict() for c in S.DAILY_COLUMNS)


@pytest.mark.parametrize("strategy", ["aggregate", "join"])
def test_two_days_sharing_one_ly_day_do_not_inflate_ty(spark, strategy):
    # 53-week style calendar: 2000-01-05 and 2000-01-06 both point at 1999-01-06
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 1, 31), overrides={20000106: 19990106})
    stg = staging_rows(
        spark,
        [
            {"period_key": 20000105, "total_units_ty": 10, "ly_period_key": 19990106},
            {"period_key": 20000106, "total_units_ty": 20, "ly_period_key": 19990106},
            {"period_key": 19990106, "total_units_ty": 4},
        ],
    )
    d = build_daily(stg, cal, strategy=strategy).where(F.col(S.PERIOD) >= 20000101)
    tot = d.agg(F.sum("total_units_ty"), F.sum("total_units_ly"), F.count("*")).first()
    assert tot[0] == 30.0  # TY never inflates
    assert tot[1] == 8.0  # LY repeats on both days
    assert tot[2] == 2
    # the chained shape duplicates TY here
    ch = build_daily_chained(stg, cal).where(F.col(S.PERIOD) >= 20000101)
    assert ch.agg(F.sum("total_units_ty")).first()[0] > 30.0


@pytest.mark.parametrize("strategy", ["aggregate", "join"])
def test_null_keys_stay_one_sided_without_zero_rows(spark, strategy):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 1, 31))
    stg = staging_rows(
        spark,
        [
            {"period_key": 20000105, "item_key": None, "total_units_ty": 5},
            {"period_key": 19990106, "item_key": None, "total_units_ty": 3},
            {"period_key": 20000105, "total_units_ty": 1},
        ],
    )
    d = build_daily(stg, cal, strategy=strategy)
    rows = d.collect()
    zero = [r for r in rows if all(r[c] == 0.0 for c in S.FINAL_METRICS)]
    assert zero == []
    nulls = [r for r in rows if r[S.ITEM] is None]
    # TY null-key row, its own TY row of 1999, and the 1999 row shifted forward as LY-only
    got = sorted((r[S.PERIOD], r["total_units_ty"], r["total_units_ly"]) for r in nulls)
    assert got == [(19990106, 3.0, 0.0), (20000105, 0.0, 3.0), (20000105, 5.0, 0.0)]


def test_range_shorter_than_a_year_finds_ly(spark):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    rows = []
    d = dt.date(1999, 1, 1)
    while d <= dt.date(2000, 3, 31):
        rows.append({"period_key": key(d), "total_units_ty": d.day})
        d += dt.timedelta(days=1)
    stg = staging_rows(spark, rows)
    out = build_daily(stg, cal, 20000101, 20000131).collect()
    assert {r[S.PERIOD] for r in out} == {key(dt.date(2000, 1, i)) for i in range(1, 32)}
    assert all(r["total_units_ly"] > 0 for r in out)
    r = [x for x in out if x[S.PERIOD] == 20000115][0]
    assert r["total_units_ly"] == float(dt.date(1999, 1, 16).day)


def test_range_with_no_calendar_days_gives_ty_only(spark):
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(1999, 12, 31))
    stg = staging_rows(spark, [{"period_key": 20000105, "total_units_ty": 5}])
    out = build_daily(stg, cal, 20000101, 20000131).collect()
    assert [(r[S.PERIOD], r["total_units_ty"], r["total_units_ly"]) for r in out] == [(20000105, 5.0, 0.0)]


def test_short_form_equals_chained_form_on_random_data(spark):
    rnd = random.Random(7)
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    rows, seen = [], set()
    for _ in range(400):
        d = dt.date(1999, 1, 1) + dt.timedelta(days=rnd.randrange(730))
        k = (key(d), rnd.randrange(3), rnd.randrange(3))
        if k in seen:
            continue
        seen.add(k)
        rows.append({"period_key": k[0], "item_key": k[1], "store_key": k[2], "total_units_ty": rnd.randrange(1, 50),
                     "osa_duration_ty": rnd.randrange(0, 9) / 2})
    stg = staging_rows(spark, rows)
    short = build_daily(stg, cal)
    for other in (build_daily_chained(stg, cal), build_daily(stg, cal, strategy="aggregate")):
        assert short.count() == other.count()
        assert short.exceptAll(other).count() == 0
        assert other.exceptAll(short).count() == 0


def test_ly_shift_moves_rows_forward(spark):
    cal = make_calendar(spark, dt.date(2000, 1, 1), dt.date(2000, 1, 31))
    stg = staging_rows(spark, [{"period_key": 19990106, "total_units_ty": 3}])
    r = ly_shift(stg, cal).collect()
    assert [(x[S.PERIOD], x[S.LY_PERIOD], x["total_units_ly"]) for x in r] == [(20000105, 19990106, 3.0)]


def test_key_fallback_blank_and_null(spark):
    df = spark.createDataFrame([("", "x"), (None, "y"), ("a", "z"), (" ", "w")], "c string, f string")
    got = [r[0] for r in df.select(key_fallback("c", "f")).collect()]
    assert got == ["x", "y", "a", " "]


def test_look_back_off_parity_with_range_filtered_source(spark):
    """Passing the range-filtered rows as both sides reproduces the old result:
    a one-month range then finds no LY values at all."""
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    rows = []
    d = dt.date(1999, 1, 1)
    while d <= dt.date(2000, 1, 31):
        rows.append({"period_key": key(d), "total_units_ty": 1})
        d += dt.timedelta(days=1)
    stg = staging_rows(spark, rows)
    in_range = stg.where(F.col(S.PERIOD).between(20000101, 20000131))
    off = build_daily(in_range, cal, ly_source=in_range).where(F.col(S.PERIOD).between(20000101, 20000131))
    assert off.where(F.col("total_units_ly") != 0).count() == 0
    on = build_daily(stg, cal, 20000101, 20000131)
    assert on.where(F.col("total_units_ly") == 0).count() == 0


def test_join_and_aggregate_strategies_agree_with_null_keys(spark):
    rnd = random.Random(11)
    cal = make_calendar(spark, dt.date(1999, 1, 1), dt.date(2000, 6, 30), overrides={20000110: 19990112})
    rows, seen = [], set()
    for _ in range(300):
        d = dt.date(1999, 1, 1) + dt.timedelta(days=rnd.randrange(540))
        item = rnd.choice([None, 0, 1, 2])
        store = rnd.choice([None, 0, 1])
        k = (key(d), item, store)
        if k in seen:
            continue
        seen.add(k)
        rows.append({"period_key": k[0], "item_key": item, "store_key": store,
                     "total_units_ty": rnd.randrange(1, 40), "rs_inventory_ty": rnd.choice([0, 3, 5])})
    stg = staging_rows(spark, rows)
    for rng in ((None, None), (20000101, 20000131)):
        a = build_daily(stg, cal, *rng, strategy="join")
        b = build_daily(stg, cal, *rng, strategy="aggregate")
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
