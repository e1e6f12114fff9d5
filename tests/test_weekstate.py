"""Weekly states: any sequence of upserts gives what a full rebuild of the weeks gives."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from shelfroll import schema as S
from shelfroll.operators.weekly import build_weekly
from shelfroll.operators.weekstate import STATE_SCHEMA, advanced, consistent, week_states, weekly_from_states

FIRST = dt.date(2000, 1, 2)  # a Sunday


def _row(rng, day: dt.date, item, store=1, nulls=False):
    vals = {
        S.RETAILER: 1, S.VENDOR: 1, S.PERIOD: day.year * 10000 + day.month * 100 + day.day,
        S.WEEK_ENDED: day + dt.timedelta(days=(5 - day.weekday()) % 7), S.ITEM: item, S.STORE: store, S.OSA_TYPE: 1,
        S.LY_PERIOD: None,
    }
    for m in S.METRICS:
        for c in (m.ty, m.ly):
            value = rng.choice([0.0, rng.randrange(-500, 100000) / 100, rng.randrange(10**9) / 10**m.scale])
            vals[c] = None if nulls and rng.random() < 0.3 else value
    return tuple(vals[c] for c in S.DAILY_COLUMNS)


def _frame(spark, rows):
    return spark.createDataFrame(rows, S.DAILY_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _day(row):
    return row[S.DAILY_COLUMNS.index(S.PERIOD)]


@pytest.mark.parametrize("nulls", [False, True])
def test_random_upserts_equal_a_rebuild(spark, nulls):
    rng = random.Random(7 + nulls)
    days = [FIRST + dt.timedelta(days=i) for i in range(21)]
    entities = [(1, 1), (1, 2), (2, 1), (None, 1)]
    rows = [_row(rng, d, i, s, nulls) for d in days for i, s in entities if rng.random() < 0.7]
    states = week_states(_frame(spark, rows))
    assert _rows(weekly_from_states(states)) == _rows(build_weekly(_frame(spark, rows)))
    for _ in range(4):
        changed = set(rng.sample(days, rng.randrange(1, 9)))
        keys = {d.year * 10000 + d.month * 100 + d.day for d in changed}
        before = [r for r in rows if _day(r) in keys]
        after = [_row(rng, d, i, s, nulls) for d in sorted(changed) for i, s in entities if rng.random() < 0.6]
        rows = [r for r in rows if _day(r) not in keys] + after
        moved = advanced(states, _frame(spark, before), _frame(spark, after))
        assert consistent(moved)
        states = spark.createDataFrame(moved.collect(), STATE_SCHEMA)
        assert _rows(states) == _rows(week_states(_frame(spark, rows)))
        assert _rows(weekly_from_states(states)) == _rows(build_weekly(_frame(spark, rows)))


def test_the_last_positive_day_can_go_and_come_back(spark):
    rng = random.Random(1)

    def row(day, ty, ly):
        r = dict(zip(S.DAILY_COLUMNS, _row(rng, FIRST + dt.timedelta(days=day), 1), strict=True))
        r["rs_inventory_ty"], r["rs_inventory_ly"] = ty, ly
        return tuple(r[c] for c in S.DAILY_COLUMNS)

    def last(states):
        w = weekly_from_states(states).first()
        return w["rs_inventory_ty"], w["rs_inventory_ly"]

    rows = [row(0, 5.0, 1.0), row(3, 7.0, 2.0), row(5, 0.0, 9.0)]
    states = week_states(_frame(spark, rows))
    assert last(states) == (7.0, 2.0)
    zero = row(3, 0.0, 2.0)
    states = advanced(states, _frame(spark, [rows[1]]), _frame(spark, [zero]))
    assert last(states) == (5.0, 1.0)
    late = row(6, 1.0, 0.0)
    states = advanced(states, _frame(spark, [rows[0]]), _frame(spark, [late]))
    assert last(states) == (1.0, 0.0)
    states = advanced(states, _frame(spark, [late]), _frame(spark, []))
    assert last(states) == (None, None)
    assert advanced(states, _frame(spark, [zero, rows[2]]), _frame(spark, [])).count() == 0


def test_empty_frames_and_rows_never_held(spark):
    rng = random.Random(2)
    none = _frame(spark, [])
    assert week_states(none).count() == 0 and weekly_from_states(week_states(none)).columns == S.WEEKLY_COLUMNS
    assert advanced(week_states(none), none, none).count() == 0
    stray = advanced(week_states(none), _frame(spark, [_row(rng, FIRST, 1)]), none)
    assert not consistent(stray)


def test_one_exchange_after_the_partial_states(spark, tmp_path):
    """Stored states and changed days: each side is aggregated once on the weekly grain, no join."""
    rng = random.Random(3)
    week_states(_frame(spark, [_row(rng, FIRST, 1)])).write.parquet(f"{tmp_path}/states")
    states = spark.read.schema(STATE_SCHEMA).parquet(f"{tmp_path}/states")
    rows = _frame(spark, [_row(rng, FIRST, 1)])
    plan = advanced(states, rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") <= 3
