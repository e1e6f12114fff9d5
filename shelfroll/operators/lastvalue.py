"""Last non-empty value per week.

For a (TY, LY) metric pair, per entity and week: the values of the latest
day whose TY value is > 0. LY comes from that same day, even when it is 0.
A week with no such day yields no value (null after the left join into the
weekly table, never 0).

Spark form: ``max_by(value, CASE WHEN ty > 0 THEN period_key END)`` inside
the weekly aggregation. Rows failing the test have a null ordering and are
ignored, so this is the filtered arg-max in a single hash aggregate with
map-side partial aggregation: one exchange, no join. The three-step form
(filter, max period per week, join back) is kept as
:func:`last_nonempty_selfjoin` for equivalence tests.

A null key is a key like any other: its rows form a group of their own, in
the aggregate as in the joins, which compare keys null-safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def _pair(metric: str) -> tuple[str, str]:
    m = S.METRIC_BY_NAME[metric]
    return m.ty, m.ly


def last_positive(value: str, test: str) -> Column:
    """Aggregate: ``value`` on the latest ``period_key`` where ``test > 0``."""
    return F.max_by(F.col(value), F.when(F.col(test) > 0, F.col(S.PERIOD)))


def positive_rows(daily: DataFrame, metric: str) -> DataFrame:
    """Daily rows whose TY value of ``metric`` is > 0, with the week keys and the pair."""
    ty, ly = _pair(metric)
    return daily.where(F.col(ty) > 0).select(*S.K5, S.WEEK_ENDED, S.PERIOD, ty, ly)


def max_period_in_week(daily: DataFrame, metric: str) -> DataFrame:
    """Latest day per entity and week with TY ``metric`` > 0."""
    return positive_rows(daily, metric).groupBy(*S.K5, S.WEEK_ENDED).agg(F.max(S.PERIOD).alias(S.PERIOD))


def last_nonempty(daily: DataFrame, metric: str) -> DataFrame:
    """(TY, LY) of the last day with TY > 0, per entity and week (aggregate form)."""
    ty, ly = _pair(metric)
    return (
        daily.groupBy(*S.WEEK_KEYS)
        .agg(last_positive(ty, ty).alias(ty), last_positive(ly, ty).alias(ly))
        .where(F.col(ty).isNotNull())
    )


def last_nonempty_selfjoin(daily: DataFrame, metric: str) -> DataFrame:
    """Same result as :func:`last_nonempty` via max-period ⨝ positive rows."""
    ty, ly = _pair(metric)
    rows = positive_rows(daily, metric)
    latest = max_period_in_week(daily, metric)
    keys = S.K5 + [S.WEEK_ENDED, S.PERIOD]
    latest = latest.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(latest, same, "inner").select(*S.WEEK_KEYS, ty, ly)


def inventory_sorted(daily: DataFrame, metric: str) -> DataFrame:
    """Positive rows ordered by item, store, type, week, day (a global sort)."""
    return positive_rows(daily, metric).orderBy(S.ITEM, S.STORE, S.OSA_TYPE, S.WEEK_ENDED, S.PERIOD)
