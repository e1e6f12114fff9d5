"""DuckDB text for the correctness oracle.

Each builder returns a SQL string DuckDB runs over the shared test tables
(registered as views). It restates the semantics independently of the Spark
code: measures are carried as integer units (cents for sums, millionths for
daily averages), averages are rounded HALF_UP with integer arithmetic, and
values become doubles only in the final projection, which is what the Spark
side's decimal aggregates produce.
"""

from __future__ import annotations

from .. import schema as S
from ..sources.fixtures import CALENDAR_SQL, FACT_SQL

#: as-of day and look-back of the calendar window used by the fixture queries
AS_OF = 20011231
YEARS = 3

K5 = ", ".join(S.K5)
K6 = ", ".join(S.K6)
WK = ", ".join(S.WEEK_KEYS)


def units_to_double(expr: str, scale: int) -> str:
    return f"CAST(CAST({expr} AS DOUBLE) / {float(10 ** scale)!r} AS DOUBLE)"


def half_up_div(total: str, n: str, factor: int) -> str:
    """round_half_up(total * factor / n) for integer ``total`` and count ``n``."""
    q = f"((abs({total}) * {2 * factor} + {n}) // (2 * {n}))"
    return f"(CASE WHEN {n} = 0 THEN NULL WHEN {total} < 0 THEN -{q} ELSE {q} END)"


def rounded_units(col: str) -> str:
    """A double measure → HALF_UP cents as an integer, read at 8 places."""
    return f"CAST(round(CAST({col} AS DECIMAL(28,8)), 2) * 100 AS HUGEINT)"


def base_ctes() -> str:
    return f"fact AS ({FACT_SQL}),\ncal AS ({CALENDAR_SQL})"


def window_cte(name: str = "calw") -> str:
    return f"{name} AS (SELECT * FROM cal WHERE period_key < {AS_OF} AND year > {AS_OF // 10000 - YEARS})"


def staging_units_cte() -> str:
    """Staging with measures in units: cents for sums, millionths for the average."""
    r = ",\n       ".join(f"{rounded_units(m.name)} AS {m.name}" for m in S.METRICS)
    aggs = []
    for m in S.METRICS:
        if m.daily == "sum":
            aggs.append(f"sum({m.name}) AS {m.ty}")
        else:
            aggs.append(f"{half_up_div(f'sum({m.name})', f'count({m.name})', 10 ** 4)} AS {m.ty}")
    return (
        f"r AS (SELECT {K6},\n       {r}\n  FROM fact),\n"
        f"agg AS (SELECT {K6}, {', '.join(aggs)} FROM r GROUP BY {K6}),\n"
        f"stg AS (SELECT agg.*, cal.ly_period_key, cal.year_week AS ty_year_week, cal.week_ended "
        f"FROM agg JOIN cal USING (period_key))"
    )


def daily_units_cte(lo: int | None = None, hi: int | None = None) -> str:
    """TY ⟗ shifted LY in units, zero-filled (short form); optional TY day range."""
    ly_cols = ", ".join(f"s.{m.ty} AS {m.ly}" for m in S.METRICS)
    k5s = ", ".join(f"s.{k}" for k in S.K5)
    on = " AND ".join(f"t.{k} = l.{k}" for k in S.K6)
    keys = ", ".join(f"coalesce(t.{k}, l.{k}) AS {k}" for k in S.K6)
    metrics = ", ".join(
        [f"coalesce(t.{c}, 0) AS {c}" for c in S.TY_METRICS] + [f"coalesce(l.{c}, 0) AS {c}" for c in S.LY_METRICS]
    )
    rng = f" AND period_key BETWEEN {lo} AND {hi}" if lo is not None else ""
    ty_src = f"(SELECT * FROM stg WHERE TRUE{rng})" if lo is not None else "stg"
    cal_src = f"(SELECT * FROM calw WHERE TRUE{rng})" if lo is not None else "calw"
    return (
        f"{window_cte()},\n"
        f"ly AS (SELECT {k5s}, w.period_key, w.week_ended, s.period_key AS ly_period_key, {ly_cols} "
        f"FROM stg s JOIN {cal_src} w ON s.period_key = w.ly_period_key),\n"
        f"dly AS (SELECT {keys}, coalesce(t.week_ended, l.week_ended) AS week_ended, "
        f"coalesce(t.ly_period_key, l.ly_period_key) AS ly_period_key, {metrics} "
        f"FROM {ty_src} t FULL OUTER JOIN ly l ON {on})"
    )


def weekly_units_cte() -> str:
    aggs = []
    for m in S.METRICS:
        for c in (m.ty, m.ly):
            if m.weekly == "sum":
                aggs.append(f"sum({c}) AS {c}")
            elif m.weekly == "avg":
                aggs.append(f"{half_up_div(f'sum({c})', f'count({c})', 10 ** 4)} AS {c}")
            else:
                aggs.append(f"arg_max({c}, period_key) FILTER (WHERE {m.ty} > 0) AS {c}")
    return f"wk AS (SELECT {WK}, {', '.join(aggs)} FROM dly GROUP BY {WK})"


def metric_out(c: str, weekly: bool = False, expr: str | None = None, alias: str | None = None) -> str:
    """Final double of the units column ``c`` (or of ``expr`` in ``c``'s units)."""
    m = S.METRIC_BY_NAME[c.rsplit("_", 1)[0]]
    scale = (10 if weekly else 6) if m.daily == "avg" else 2
    return f"{units_to_double(expr or c, scale)} AS {alias or c}"


def staging_sql() -> str:
    cols = ", ".join(
        list(S.K6) + [metric_out(c) for c in S.TY_METRICS] + ["ly_period_key", "ty_year_week", "week_ended"]
    )
    return f"WITH {base_ctes()},\n{staging_units_cte()}\nSELECT {cols} FROM stg"


def daily_sql() -> str:
    cols = ", ".join(
        ["retailer_key", "vendor_key", "period_key", "week_ended", "item_key", "store_key", "osa_type_key"]
        + [metric_out(c) for c in S.FINAL_METRICS]
        + ["ly_period_key"]
    )
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{daily_units_cte()}\nSELECT {cols} FROM dly"


def weekly_sql() -> str:
    cols = ", ".join(list(S.WEEK_KEYS) + [metric_out(c, weekly=True) for c in S.FINAL_METRICS] + ["week_ended AS x_week_ended"])
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{daily_units_cte()},\n{weekly_units_cte()}\nSELECT {cols} FROM wk"


def with_daily(select: str) -> str:
    """Any SELECT over the units-form daily CTE ``dly``."""
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{daily_units_cte()}\n{select}"


def with_staging(select: str) -> str:
    return f"WITH {base_ctes()},\n{staging_units_cte()}\n{select}"


def with_daily_range(lo: int, hi: int, select: str) -> str:
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{daily_units_cte(lo, hi)}\n{select}"


def with_daily_weeks(lo: int, hi: int, select: str) -> str:
    """Any SELECT over daily rows whose day lies in a calendar week that touches [lo, hi]."""
    weeks = f"SELECT DISTINCT week_ended FROM cal WHERE period_key BETWEEN {lo} AND {hi}"
    days = f"SELECT period_key FROM cal WHERE week_ended IN ({weeks})"
    narrowed = daily_units_cte().replace("FROM stg t FULL", f"FROM (SELECT * FROM stg WHERE period_key IN ({days})) t FULL").replace(
        "JOIN calw w ON", f"JOIN (SELECT * FROM calw WHERE period_key IN ({days})) w ON"
    )
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{narrowed}\n{select}"


def job_log_sql(bounds: tuple[int, int], clock) -> str:
    """The steps of a full load over all vendors, in order, with each stage's row count."""
    lo, hi = bounds
    weeks = f"SELECT DISTINCT week_ended FROM cal WHERE period_key BETWEEN {lo} AND {hi}"
    span = f"(SELECT '[(' || min(period_key) || ', ' || max(period_key) || ')]' FROM cal WHERE week_ended IN ({weeks}))"
    off = "(SELECT count(*) FROM agg WHERE period_key NOT IN (SELECT period_key FROM cal))"
    steps = [
        (f"'Parameters checked: load type FL, vendors [0, 1, 2], range {lo}..{hi}'", "Success"),
        ("'Staging started'", "In-Progress"),
        (f"'Staging loaded for vendors [0, 1, 2]: ' || (SELECT count(*) FROM stg) || ' rows; ' || {off} || ' daily rows had no calendar day'", "Success"),
        ("'Daily full started'", "In-Progress"),
        (f"'Daily full done for ' || {span} || ': ' || (SELECT count(*) FROM dly) || ' rows'", "Success"),
        ("'Weekly full started'", "In-Progress"),
        (f"'Weekly full done for ' || {span} || ': ' || (SELECT count(*) FROM wk) || ' rows'", "Success"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT CAST(1 AS INTEGER) AS \"JobId\", 'Step {i}' AS \"JobStep\", {text} AS \"JobDescription\", "
        f"'{clock:%Y-%m-%d %H:%M:%S}' AS \"StartTime\", '{status}' AS \"Status\""
        for i, (text, status) in enumerate(steps, 1)
    )
    return with_weekly(rows)


def job_status_sql(bounds: tuple[int, int], clock) -> str:
    """The last of those steps for every stage (the first word of the description)."""
    log = job_log_sql(bounds, clock)
    at = log.rindex("SELECT CAST(1 AS INTEGER) AS \"JobId\", 'Step 1'")
    stages = "SELECT *, split_part(\"JobDescription\", ' ', 1) AS stage, CAST(split_part(\"JobStep\", ' ', 2) AS INTEGER) AS step FROM steps"
    return (
        f"{log[:at].rstrip()},\nsteps AS ({log[at:]})\n"
        'SELECT "JobId", stage, "JobStep", "JobDescription", "StartTime", "Status" FROM ('
        f"SELECT *, max(step) OVER (PARTITION BY stage) AS last FROM ({stages})) WHERE step = last"
    )


def with_weekly(select: str) -> str:
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{daily_units_cte()},\n{weekly_units_cte()}\n{select}"


def metric_out_as(col: str, alias: str, weekly: bool = False) -> str:
    """Like :func:`metric_out` for a units column named ``col``, output as ``alias``."""
    return metric_out(col, weekly, alias=alias)


def chained_ctes() -> str:
    """Bridge ⟗ staging (j2), then ⨝ windowed calendar (j3), in units."""
    on = " AND ".join(f"b.{k} = s.{k}" for k in S.K6)
    k5 = ", ".join(f"coalesce(b.{k}, s.{k}) AS {k}" for k in S.K5)
    ly = ", ".join(f"s.{m.ty} AS {m.ly}" for m in S.METRICS)
    return (
        f"{window_cte()},\n"
        f"b AS (SELECT {K5}, ly_period_key AS period_key FROM stg),\n"
        f"j2 AS (SELECT coalesce(b.period_key, s.period_key) AS ly_period_key, {k5}, {ly} "
        f"FROM b FULL OUTER JOIN stg s ON {on}),\n"
        f"j3 AS (SELECT j2.*, w.period_key AS x_period_key, w.week_ended AS x_week_ended "
        f"FROM j2 JOIN calw w ON j2.ly_period_key = w.ly_period_key)"
    )


def with_chained(select: str) -> str:
    return f"WITH {base_ctes()},\n{staging_units_cte()},\n{chained_ctes()}\n{select}"


LY_BRIDGE_FULL_SELECT = (
    f"SELECT ly_period_key, {K5}, " + ", ".join(metric_out(c) for c in S.LY_METRICS) + " FROM j2"
)
LY_BRIDGE_FULL_ZERO_SELECT = (
    f"SELECT ly_period_key, {K5}, "
    + ", ".join(metric_out(c, expr=f"coalesce({c}, 0)") for c in S.LY_METRICS)
    + " FROM j2"
)
KEY_FALLBACK_SELECT = (
    "SELECT "
    + ", ".join(f"coalesce(t.{k}, l.{k}) AS {k}" for k in S.K5)
    + ", coalesce(t.ly_period_key, l.ly_period_key) AS ly_period_key, "
    "coalesce(nullif(CAST(t.period_key AS VARCHAR), ''), CAST(l.x_period_key AS VARCHAR)) AS period_text, "
    "coalesce(nullif(CAST(t.week_ended AS VARCHAR), ''), CAST(l.x_week_ended AS VARCHAR)) AS week_text "
    "FROM stg t FULL OUTER JOIN j3 l ON t.ly_period_key = l.ly_period_key AND "
    + " AND ".join(f"t.{k} = l.{k}" for k in S.K5)
)

GROUP_AGG_SQL = (
    f"WITH {base_ctes()},\n{staging_units_cte()}\n"
    f"SELECT vendor_key, osa_type_key, {units_to_double('sum(total_units)', 2)} AS sum_total_units, "
    f"{units_to_double(half_up_div('sum(osa_duration)', 'count(osa_duration)', 10 ** 4), 6)} AS avg_osa_duration, "
    "min(period_key) AS first_period, max(period_key) AS last_period, count(total_sales) AS n_sales "
    "FROM r GROUP BY vendor_key, osa_type_key"
)
