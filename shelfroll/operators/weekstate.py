"""Mergeable weekly states: a week follows its changed days without its other days being read.

A state holds, for one entity and week, what the weekly roll-up needs in a form that days can be added to and taken
from: the number of daily rows, integer units and value counts of every summed or averaged metric, and for each
last-value metric the days whose TY value is > 0 with their pair of values (seven at most, as the daily grain is
unique). Sums are integers, so taking a day away leaves exactly what a rebuild would give.

An upsert that replaces the daily rows ``before`` by ``after`` needs the states of the touched weeks and these two
frames: :func:`advanced` is one union and one hash aggregate on the weekly grain (one exchange; three rows a group at
most after the partial aggregates), and :func:`weekly_from_states` is a projection.

Edge cases: null keys are groups of their own; a null measure counts no value (a sum or average of nulls only is null);
a null day never is the last one; empty frames give no state; an entity whose last row of a week goes leaves no state;
rows taken away that were never added leave a state with ``rows`` below 0, which :func:`consistent` reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.numeric import avg_units, from_units, stored_units
from .weekly import AVERAGED, LAST_VALUE, SUMMED, WEEKLY_AVG_EXTRA_SCALE

ROWS = "rows"
_MEASURES = [(c, m) for m in SUMMED + AVERAGED for c in (m.ty, m.ly)]
_UNITS = {c: f"{c}_units" for c, _ in _MEASURES}
_COUNTS = {c: f"{c}_n" for c, _ in _MEASURES}
_DAYS = {m.name: f"{m.name}_days" for m in LAST_VALUE}
_TOTALS = [ROWS, *_UNITS.values(), *_COUNTS.values()]

_PAIR = T.StructType(
    [T.StructField("day", T.IntegerType()), T.StructField("ty", T.DoubleType()), T.StructField("ly", T.DoubleType())]
)
STATE_COLUMNS = [*S.WEEK_KEYS, *_TOTALS, *_DAYS.values()]
STATE_SCHEMA = T.StructType(
    [T.StructField(k, T.DateType() if k == S.WEEK_ENDED else T.IntegerType()) for k in S.WEEK_KEYS]
    + [T.StructField(c, T.LongType()) for c in _TOTALS]
    + [T.StructField(c, T.ArrayType(_PAIR)) for c in _DAYS.values()]
)


def week_states(daily: DataFrame) -> DataFrame:
    """The states of every entity and week of ``daily``."""
    totals: list[Column] = [F.count("*").alias(ROWS)]
    for c, m in _MEASURES:
        units = stored_units(c, m.scale)
        totals += [F.coalesce(F.sum(units), F.lit(0)).alias(_UNITS[c]), F.count(units).alias(_COUNTS[c])]
    days = []
    for m in LAST_VALUE:
        pair = F.struct(F.col(S.PERIOD).cast("int").alias("day"), F.col(m.ty).alias("ty"), F.col(m.ly).alias("ly"))
        positive = (F.col(m.ty) > 0) & F.col(S.PERIOD).isNotNull()
        days.append(F.array_sort(F.collect_list(F.when(positive, pair))).alias(_DAYS[m.name]))
    return daily.groupBy(*S.WEEK_KEYS).agg(*totals, *days).select(*STATE_COLUMNS)


def advanced(states: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """``states`` after the daily rows ``before`` were replaced by ``after`` (both in the daily layout).

    ``states`` must cover every week ``before`` and ``after`` touch; states of other weeks pass through.
    """
    signed = [
        frame.select(*STATE_COLUMNS, F.lit(sign).alias("_sign"), F.lit(stored).alias("_stored"))
        for frame, sign, stored in ((states, 1, True), (week_states(after), 1, False), (week_states(before), -1, False))
    ]
    every = signed[0].unionByName(signed[1]).unionByName(signed[2])
    sums = [F.sum(F.col(c) * F.col("_sign")).alias(c) for c in _TOTALS]
    gone, new, held = (F.col("_sign") < 0, (F.col("_sign") > 0) & ~F.col("_stored"), F.col("_stored"))
    lists = [
        F.flatten(F.collect_list(F.when(which, F.col(c)))).alias(f"_{part}_{c}")
        for c in _DAYS.values()
        for part, which in (("gone", gone), ("new", new), ("held", held))
    ]
    merged = every.groupBy(*S.WEEK_KEYS).agg(*sums, *lists)
    return merged.where(F.col(ROWS) != 0).select(*S.WEEK_KEYS, *_TOTALS, *[_merged_days(c).alias(c) for c in _DAYS.values()])


def _merged_days(c: str) -> Column:
    """The stored days less those taken away, and the new ones."""
    taken = F.transform(F.col(f"_gone_{c}"), lambda pair: pair["day"])
    kept = F.filter(F.col(f"_held_{c}"), lambda pair: ~F.array_contains(taken, pair["day"]))
    return F.array_sort(F.concat(kept, F.col(f"_new_{c}")))


def consistent(states: DataFrame) -> bool:
    """Whether no state has had rows taken away that it never held."""
    return states.where(F.col(ROWS) < 0).isEmpty()


def weekly_from_states(states: DataFrame) -> DataFrame:
    """The weekly table (23 columns): equal to ``build_weekly`` of the days the states stand for."""
    metrics: dict[str, Column] = {}
    for c, m in _MEASURES:
        units, n = F.col(_UNITS[c]), F.col(_COUNTS[c])
        if m.weekly == "sum":
            metrics[c] = F.when(n > 0, from_units(units, m.scale))
        else:
            out = m.scale + WEEKLY_AVG_EXTRA_SCALE
            metrics[c] = from_units(avg_units(units, n, m.scale, out), out)
    for m in LAST_VALUE:
        last = F.array_max(_DAYS[m.name])
        metrics[m.ty], metrics[m.ly] = last["ty"], last["ly"]
    return states.select(
        *S.WEEK_KEYS,
        *[metrics[c].cast("double").alias(c) for c in S.FINAL_METRICS],
        F.col(S.WEEK_ENDED).alias(S.X_WEEK_ENDED),
    )
