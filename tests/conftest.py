from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfroll import schema as S  # noqa: E402
from shelfroll.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="shelfroll-tests")
    yield s


def key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def make_calendar(spark, start: dt.date, end: dt.date, ly_days: int = 364, overrides: dict | None = None):
    """Calendar rows for [start, end]; ``overrides`` maps period key → ly key."""
    rows = []
    d = start
    while d <= end:
        ly = d - dt.timedelta(days=ly_days)
        we = d + dt.timedelta(days=(5 - d.weekday()) % 7)  # Saturday
        k = key(d)
        lyk = (overrides or {}).get(k, key(ly))
        rows.append((k, lyk, we, d.month, d.year, d.year * 100 + d.isocalendar()[1]))
        d += dt.timedelta(days=1)
    return spark.createDataFrame(rows, S.CALENDAR_SCHEMA)


def staging_rows(spark, rows):
    """rows: dicts with keys (defaults 1) and *_ty metrics (default 0); calendar-free."""
    out = []
    for r in rows:
        p = r["period_key"]
        d = dt.date(p // 10000, (p // 100) % 100, p % 100)
        ly = r.get("ly_period_key", key(d - dt.timedelta(days=364)))
        we = d + dt.timedelta(days=(5 - d.weekday()) % 7)
        vals = [r.get(k, 1) for k in S.K6[:2]] + [p] + [r.get(k, 1) for k in S.K6[3:]]
        vals += [float(r.get(m, 0.0)) for m in S.TY_METRICS]
        vals += [ly, d.year * 100 + d.isocalendar()[1], we]
        out.append(tuple(vals))
    return spark.createDataFrame(out, S.STAGING_SCHEMA)
