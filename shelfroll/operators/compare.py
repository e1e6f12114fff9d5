"""Daily this-year / last-year comparison.

Every staging row is a TY value for its own day and an LY value for the day
(or days) whose calendar LY key points at it. The short form used here:

1. shift the LY source forward through the calendar
   (``staging.period_key = calendar.ly_period_key``; the planner broadcasts the calendar),
2. full-outer-join TY and shifted LY on ``period_key`` + the five entity
   keys (two exchanges of staging-sized data, one sort-merge join); a union
   followed by one hash aggregate is available as an alternative strategy
   (one exchange of the same rows),
3. coalesce keys, zero-fill missing metrics.

The earlier three-join shape (bridge ⟗ TY, ⨝ calendar, ⟗ TY) is kept as
:func:`build_daily_chained` for equivalence tests and the baseline benchmark;
it also duplicates TY when two days share an LY day, and emits all-zero rows
for null keys, which the short form does not.

Rows with a null entity key can never match; a salt column keeps them
one-sided and spreads them over all partitions so they cannot pile up in one
task. The grouping key is the unique daily grain, so no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .calendar import calendar_alias, ly_bounds, period_between
from .joins import null_key_salt

_SALT = "_null_key_salt"


def ly_bridge(staging: DataFrame) -> DataFrame:
    """The five entity keys with each row's LY key presented as ``period_key``."""
    return staging.select(
        S.RETAILER, S.VENDOR, F.col(S.LY_PERIOD).cast("int").alias(S.PERIOD), S.ITEM, S.STORE, S.OSA_TYPE
    )


def rename_to_ly() -> list[Column]:
    """TY metric columns renamed to their LY names."""
    return [F.col(m.ty).alias(m.ly) for m in S.METRICS]


def ly_shift(ly_source: DataFrame, calendar: DataFrame, salt: bool = False) -> DataFrame:
    """LY rows moved forward to the TY day(s) whose LY day they are.

    Output: the six keys (``period_key`` = TY day), ``week_ended`` of that TY
    day, ``ly_period_key`` = the source row's own day, and ``*_ly`` metrics.
    When two TY days share one LY day the LY row appears on both. With
    ``salt`` the null-key salt column used by :func:`build_daily` is added.
    """
    cal = calendar.select(
        F.col(S.PERIOD).alias("_ty_day"), F.col(S.LY_PERIOD).alias("_ly_day"), F.col(S.WEEK_ENDED).alias("_ty_week")
    )
    j = ly_source.join(cal, F.col(S.PERIOD) == F.col("_ly_day"), "inner")
    extra = [null_key_salt(S.K5 + ["_ty_day"], S.TY_METRICS).alias(_SALT)] if salt else []
    return j.select(
        S.RETAILER,
        S.VENDOR,
        F.col("_ty_day").alias(S.PERIOD),
        S.ITEM,
        S.STORE,
        S.OSA_TYPE,
        F.col("_ty_week").alias(S.WEEK_ENDED),
        F.col(S.PERIOD).cast("int").alias(S.LY_PERIOD),
        *[F.col(m.ty).alias(m.ly) for m in S.METRICS],
        *extra,
    )


def zero_fill(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing metric values → 0.0 (double)."""
    cols = S.FINAL_METRICS if cols is None else cols
    return df.select(
        *[F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def key_fallback(c: Column | str, fallback: Column | str) -> Column:
    """``c`` unless it is null or the empty string, else ``fallback``.

    Typed keys (int, date) only need the null test; for strings ``""`` also
    counts as missing (exactly ``""``, no trimming).
    """
    col = F.col(c) if isinstance(c, str) else c
    fb = F.col(fallback) if isinstance(fallback, str) else fallback
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), fb.cast("string"))


def _final_columns(metric_col) -> list[Column]:
    """The daily layout; ``metric_col(name)`` gives each metric's source column."""
    return [
        S.RETAILER,
        S.VENDOR,
        F.col(S.PERIOD).cast("int").alias(S.PERIOD),
        S.WEEK_ENDED,
        S.ITEM,
        S.STORE,
        S.OSA_TYPE,
        *[F.coalesce(metric_col(c), F.lit(0.0)).cast("double").alias(c) for c in S.FINAL_METRICS],
        F.col(S.LY_PERIOD).cast("int").alias(S.LY_PERIOD),
    ]


def _final(joined: DataFrame) -> DataFrame:
    return joined.select(*_final_columns(F.col))


def build_daily(
    staging: DataFrame,
    calendar: DataFrame,
    start: int | None = None,
    end: int | None = None,
    ly_source: DataFrame | None = None,
    strategy: str = "join",
) -> DataFrame:
    """Daily TY/LY table for the days in [start, end] (whole table when open).

    ``calendar`` is the (windowed) calendar; LY values reach only its days.
    TY rows are the staging rows in range; the LY source is read only on the
    LY days of that range (a static partition filter), so a range shorter
    than a year still finds its LY values. ``ly_source`` defaults to
    ``staging`` (pass a different frame to compare two sources).

    ``strategy``: ``join`` (default) full-outer-joins the two sides — two
    exchanges and a sort-merge join; ``aggregate`` unions them and groups
    once on the six keys — one exchange. Both shuffle the same rows and give
    identical results; with a unique grouping key the aggregate's map-side
    partial aggregation reduces nothing and spills like a sort (both timings
    are in the bench output), hence the default.
    """
    ty = staging.where(period_between(start, end)) if (start is not None or end is not None) else staging
    cal = calendar.where(period_between(start, end)) if (start is not None or end is not None) else calendar
    src = staging if ly_source is None else ly_source
    if start is not None or end is not None:
        lo, hi = ly_bounds(cal, start, end)
        if lo is None:
            src = src.limit(0)
        else:
            src = src.where(period_between(lo, hi))
    if strategy == "aggregate":
        return _combine_by_aggregate(ty, ly_shift(src, cal))
    if strategy == "join":
        return _combine_by_join(ty, ly_shift(src, cal, salt=True))
    raise ValueError(f"strategy must be 'aggregate' or 'join', got {strategy!r}")


def _ty_columns(ty: DataFrame) -> list[Column]:
    return [*S.K6, S.WEEK_ENDED, F.col(S.LY_PERIOD).cast("int").alias(S.LY_PERIOD)]


def _combine_by_aggregate(ty: DataFrame, ly: DataFrame) -> DataFrame:
    """TY ∪ shifted LY, then one hash aggregate on the six keys.

    Each key has at most one TY row and one LY row (one LY day per TY day),
    so ``max`` per column picks that row's value; keys and week prefer TY's.
    Rows with a null key get a salt that also hashes their side, so they
    stay separate one-sided rows and spread over all partitions.
    """
    none = F.lit(None).cast("double")
    t = ty.select(*_ty_columns(ty), *S.TY_METRICS, *[none.alias(c) for c in S.LY_METRICS], F.lit(True).alias("_is_ty"))
    l = ly.select(*S.K6, S.WEEK_ENDED, S.LY_PERIOD, *[none.alias(c) for c in S.TY_METRICS], *S.LY_METRICS,
                  F.lit(False).alias("_is_ty"))
    u = t.unionByName(l)
    u = u.withColumn(_SALT, null_key_salt(S.K6, u.columns))
    from_ty = F.col("_is_ty")
    g = u.groupBy(*S.K6, _SALT).agg(
        F.coalesce(F.max(F.when(from_ty, F.col(S.WEEK_ENDED))), F.max(S.WEEK_ENDED)).alias(S.WEEK_ENDED),
        F.coalesce(F.max(F.when(from_ty, F.col(S.LY_PERIOD))), F.max(S.LY_PERIOD)).alias(S.LY_PERIOD),
        *[F.max(c).alias(c) for c in S.FINAL_METRICS],
    )
    return _final(g)


def _combine_by_join(ty: DataFrame, ly: DataFrame) -> DataFrame:
    """TY ⟗ shifted LY on the six keys (plus the null-key salt); two exchanges and a sort-merge join."""
    t = ty.select(*_ty_columns(ty), *S.TY_METRICS, null_key_salt(S.K6, S.TY_METRICS).alias(_SALT)).alias("t")
    l = ly.alias("l")
    cond = [F.col(f"t.{k}") == F.col(f"l.{k}") for k in S.K6 + [_SALT]]
    j = t.join(l, cond, "full_outer")
    keys = {k: F.coalesce(F.col(f"t.{k}"), F.col(f"l.{k}")) for k in S.K6 + [S.WEEK_ENDED, S.LY_PERIOD]}
    side = {c: F.col(f"t.{c}") for c in S.TY_METRICS} | {c: F.col(f"l.{c}") for c in S.LY_METRICS}
    return j.select(
        keys[S.RETAILER].alias(S.RETAILER),
        keys[S.VENDOR].alias(S.VENDOR),
        keys[S.PERIOD].cast("int").alias(S.PERIOD),
        keys[S.WEEK_ENDED].alias(S.WEEK_ENDED),
        keys[S.ITEM].alias(S.ITEM),
        keys[S.STORE].alias(S.STORE),
        keys[S.OSA_TYPE].alias(S.OSA_TYPE),
        *[F.coalesce(side[c], F.lit(0.0)).cast("double").alias(c) for c in S.FINAL_METRICS],
        keys[S.LY_PERIOD].cast("int").alias(S.LY_PERIOD),
    )


# ---------------------------------------------------------------- chained shape
def salted_outer_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys`` in which rows with a null key spread over all partitions."""
    salted = [d.withColumn(_SALT, null_key_salt(keys, [c for c in d.columns if c not in keys])) for d in (left, right)]
    return salted[0].join(salted[1], keys + [_SALT], "full_outer").drop(_SALT)


def ly_bridge_full(staging: DataFrame) -> DataFrame:
    """Bridge ⟗ staging on the six keys: every TY key and every LY key of a TY row.

    Output ``ly_period_key`` (the matched day), the five keys and that day's
    values as ``*_ly`` (null when the day has no staging row).
    """
    bridge = ly_bridge(staging).withColumn(_SALT, null_key_salt(S.K6, []))
    days = staging.select(*S.K6, *S.TY_METRICS, null_key_salt(S.K6, S.TY_METRICS).alias(_SALT))
    j = bridge.join(days, S.K6 + [_SALT], "full_outer")
    return j.select(F.col(S.PERIOD).alias(S.LY_PERIOD), *S.K5, *rename_to_ly())


def build_daily_chained(staging: DataFrame, calendar: DataFrame) -> DataFrame:
    """Three-join form: bridge ⟗ TY, ⨝ calendar, ⟗ TY on (LY key, five keys).

    Equal to :func:`build_daily` on a one-to-one calendar with non-null keys.
    """
    ly = ly_bridge_full(staging).join(calendar_alias(calendar), S.LY_PERIOD, "inner")
    ty = staging.select(*S.K6, S.WEEK_ENDED, F.col(S.LY_PERIOD).cast("int").alias(S.LY_PERIOD), *S.TY_METRICS)
    j = salted_outer_join(ty, ly, [S.LY_PERIOD] + S.K5)
    out = j.select(
        *S.K5,
        F.coalesce(F.col(S.PERIOD), F.col("x_period_key")).alias(S.PERIOD),
        F.coalesce(F.col(S.WEEK_ENDED), F.col(S.X_WEEK_ENDED)).alias(S.WEEK_ENDED),
        S.LY_PERIOD,
        *S.TY_METRICS,
        *S.LY_METRICS,
    )
    return _final(out)
