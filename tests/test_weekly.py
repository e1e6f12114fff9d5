from __future__ import annotations

import datetime as dt
import random

from shelfroll import schema as S
from shelfroll.operators.calendar import widen_to_weeks
from shelfroll.operators.lastvalue import last_nonempty, last_nonempty_selfjoin
from shelfroll.operators.weekly import build_weekly, build_weekly_joined

from .conftest import make_calendar


def _daily(spark, rows):
    """rows: dicts with period_key and metric values (TY/LY); week from the date."""
    out = []
    for r in rows:
        p = r["period_key"]
        d = dt.date(p // 10000, (p // 100) % 100, p % 100)
        we = d + dt.timedelta(days=(5 - d.weekday()) % 7)
        vals = {
            S.RETAILER: 1, S.VENDOR: 1, S.PERIOD: p, S.WEEK_ENDED: we, S.ITEM: r.get(S.ITEM, 1), S.STORE: 1,
            S.OSA_TYPE: 1, S.LY_PERIOD: p - 10000,
        }
        for c in S.FINAL_METRICS:
            vals[c] = float(r.get(c, 0.0))
        out.append(tuple(vals[c] for c in S.DAILY_COLUMNS))
    return spark.createDataFrame(out, S.DAILY_SCHEMA)


# 2000-01-02 (Sun) .. 2000-01-08 (Sat) is one week
def test_last_nonempty_inventory_cases(spark):
    rows = [
        # item 1: zero on the last day -> earlier day wins
        {S.ITEM: 1, "period_key": 20000103, "rs_inventory_ty": 5, "rs_inventory_ly": 2},
        {S.ITEM: 1, "period_key": 20000105, "rs_inventory_ty": 0, "rs_inventory_ly": 9},
        # item 2: all zero -> null
        {S.ITEM: 2, "period_key": 20000103, "rs_inventory_ty": 0, "rs_inventory_ly": 0},
        # item 3: TY zero but LY positive -> null
        {S.ITEM: 3, "period_key": 20000104, "rs_inventory_ty": 0, "rs_inventory_ly": 7},
        # item 4: LY zero on the chosen day -> 0
        {S.ITEM: 4, "period_key": 20000102, "rs_inventory_ty": 1, "rs_inventory_ly": 5},
        {S.ITEM: 4, "period_key": 20000106, "rs_inventory_ty": 3, "rs_inventory_ly": 0},
    ]
    w = {r[S.ITEM]: r for r in build_weekly(_daily(spark, rows)).collect()}
    assert (w[1]["rs_inventory_ty"], w[1]["rs_inventory_ly"]) == (5.0, 2.0)
    assert (w[2]["rs_inventory_ty"], w[2]["rs_inventory_ly"]) == (None, None)
    assert (w[3]["rs_inventory_ty"], w[3]["rs_inventory_ly"]) == (None, None)
    assert (w[4]["rs_inventory_ty"], w[4]["rs_inventory_ly"]) == (3.0, 0.0)
    assert w[4][S.X_WEEK_ENDED] == w[4][S.WEEK_ENDED] == dt.date(2000, 1, 8)


def test_weekly_average_counts_zero_filled_days(spark):
    rows = [
        {"period_key": 20000103, "osa_duration_ty": 3.0, "total_units_ty": 1.25},
        {"period_key": 20000104, "osa_duration_ty": 0.0, "osa_duration_ly": 6.0, "total_units_ly": 2.5},
    ]
    w = build_weekly(_daily(spark, rows)).first()
    assert w["osa_duration_ty"] == 1.5
    assert w["osa_duration_ly"] == 3.0
    assert (w["total_units_ty"], w["total_units_ly"]) == (1.25, 2.5)


def test_one_aggregate_equals_join_forms_on_random_data(spark):
    rnd = random.Random(3)
    rows, seen = [], set()
    for _ in range(300):
        d = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(60))
        k = (d.year * 10000 + d.month * 100 + d.day, rnd.randrange(4))
        if k in seen:
            continue
        seen.add(k)
        r = {"period_key": k[0], S.ITEM: k[1]}
        for c in S.FINAL_METRICS:
            r[c] = rnd.choice([0, 0, rnd.randrange(1, 100) / 4])
        rows.append(r)
    daily = _daily(spark, rows)
    a = build_weekly(daily)
    for other in (build_weekly_joined(daily), build_weekly_joined(daily, selfjoin=True)):
        assert a.exceptAll(other).count() == 0 and other.exceptAll(a).count() == 0
    for m in ("rs_inventory", "retail_on_hand"):
        x, y = last_nonempty(daily, m), last_nonempty_selfjoin(daily, m)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_null_keys_are_groups_of_their_own_in_every_form(spark):
    rows = [
        {S.ITEM: None, "period_key": 20000103, "rs_inventory_ty": 5, "rs_inventory_ly": 2, "retail_on_hand_ty": 1},
        {S.ITEM: None, "period_key": 20000105, "rs_inventory_ty": 0, "rs_inventory_ly": 9},
        {S.ITEM: 1, "period_key": 20000103, "rs_inventory_ty": 7},
    ]
    daily = _daily(spark, rows)
    a = build_weekly(daily)
    got = {r[S.ITEM]: (r["rs_inventory_ty"], r["rs_inventory_ly"]) for r in a.collect()}
    assert got == {None: (5.0, 2.0), 1: (7.0, 0.0)}
    for other in (build_weekly_joined(daily), build_weekly_joined(daily, selfjoin=True)):
        assert a.exceptAll(other).count() == 0 and other.exceptAll(a).count() == 0
    x, y = last_nonempty(daily, "rs_inventory"), last_nonempty_selfjoin(daily, "rs_inventory")
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0 and x.count() == 2


def test_widen_to_weeks(spark):
    cal = make_calendar(spark, dt.date(2000, 1, 1), dt.date(2000, 2, 29))
    # 2000-01-05 (Wed) .. 2000-01-12 (Wed) -> Sun 2000-01-02 .. Sat 2000-01-15
    assert widen_to_weeks(cal, 20000105, 20000112) == (20000102, 20000115)
    assert widen_to_weeks(cal, None, None) == (None, None)


def test_weekly_columns(spark):
    w = build_weekly(_daily(spark, [{"period_key": 20000103, "total_units_ty": 1}]))
    assert w.columns == S.WEEKLY_COLUMNS
