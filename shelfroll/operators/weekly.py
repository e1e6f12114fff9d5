"""Daily TY/LY → weekly roll-up.

One hash aggregate on the weekly grain computes everything: sums, averages
(zero-filled days count, as they are rows of the daily table) and the
last-non-empty inventory pairs. Partial aggregation runs map-side, so the
plan has a single exchange whatever the skew of a key, and no join.

Sums and averages are taken on integer units at the scale the daily table
carries (cents for sums, millionths for daily averages: the daily stage writes
no finer value), so results are exact and identical across reruns; weekly
averages are rounded HALF_UP to 10 places. A null key is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import avg_as_double, stored_units, sum_as_double
from .lastvalue import last_nonempty, last_nonempty_selfjoin, last_positive

SUMMED = [m for m in S.METRICS if m.weekly == "sum"]
AVERAGED = [m for m in S.METRICS if m.weekly == "avg"]
LAST_VALUE = [m for m in S.METRICS if m.weekly == "last_positive"]


#: weekly averages keep four more places than the daily values they average
WEEKLY_AVG_EXTRA_SCALE = 4


def _sum_avg_exprs() -> list[Column]:
    out = []
    for m in SUMMED:
        for c in (m.ty, m.ly):
            out.append(sum_as_double(stored_units(c, m.scale), m.scale).alias(c))
    for m in AVERAGED:
        for c in (m.ty, m.ly):
            out.append(avg_as_double(stored_units(c, m.scale), m.scale, m.scale + WEEKLY_AVG_EXTRA_SCALE).alias(c))
    return out


def weekly_agg(daily: DataFrame) -> DataFrame:
    """Sums and averages per entity and week (no inventory columns)."""
    return daily.groupBy(*S.WEEK_KEYS).agg(*_sum_avg_exprs())


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        *S.WEEK_KEYS,
        *[F.col(c).cast("double").alias(c) for c in S.FINAL_METRICS],
        F.col(S.WEEK_ENDED).alias(S.X_WEEK_ENDED),
    )


def build_weekly(daily: DataFrame) -> DataFrame:
    """Weekly table (23 columns) in one aggregation."""
    last = []
    for m in LAST_VALUE:
        last += [last_positive(m.ty, m.ty).alias(m.ty), last_positive(m.ly, m.ty).alias(m.ly)]
    return _finish(daily.groupBy(*S.WEEK_KEYS).agg(*_sum_avg_exprs(), *last))


def weekly_with_inventory(daily: DataFrame, metrics: list[str] | None = None, selfjoin: bool = False) -> DataFrame:
    """Weekly sums ⟕ last-non-empty pairs, as explicit left joins on the weekly grain.

    Equal to :func:`build_weekly` when ``metrics`` lists both last-value
    metrics; kept to check the one-aggregate plan and as the baseline shape.
    """
    names = [m.name for m in LAST_VALUE] if metrics is None else metrics
    out = weekly_agg(daily)
    for name in names:
        part = last_nonempty_selfjoin(daily, name) if selfjoin else last_nonempty(daily, name)
        kept, values = out.columns, [c for c in part.columns if c not in S.WEEK_KEYS]
        part = part.select(*[F.col(k).alias(f"_{k}") for k in S.WEEK_KEYS], *values)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in S.WEEK_KEYS]
        out = out.join(part, same, "left").select(*kept, *values)
    return out


def build_weekly_joined(daily: DataFrame, selfjoin: bool = False) -> DataFrame:
    return _finish(weekly_with_inventory(daily, selfjoin=selfjoin))
