"""Benchmark of the headline queries.

Runs each query (noop sink) once to warm up, then ``BENCH_RUNS`` times, on
``local[BENCH_CPUS]`` over ``BENCH_SF_DIR``, and prints one JSON line with
the median seconds per query. ``value`` is the sum of the medians of the
three pipeline stages (staging, daily TY/LY, weekly). The chained-join
daily and the self-join weekly shapes are measured too, as the baseline the

Also reported: each stage alone from a checkpointed input (as the job reads
stored staging/daily) with the shuffle exchanges of its plan, including the
union-aggregate daily strategy; the stand-in fact row count and the staging
throughput in fact rows per second. ``wide_key_stages`` times the same stages
over keys that grow with the facts (every part, 500 stores), where the tables
of the first kind stop growing. Runs are interleaved across queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shelfroll import schema as S  # noqa: E402
from shelfroll.operators.calendar import calendar_window  # noqa: E402
from shelfroll.operators.compare import build_daily, build_daily_chained  # noqa: E402
from shelfroll.operators.rollup import build_staging  # noqa: E402
from shelfroll.operators.weekly import build_weekly, build_weekly_joined  # noqa: E402
from shelfroll.plans import oracle, pipeline  # noqa: E402
from shelfroll.session import local_session  # noqa: E402
from shelfroll.sources import fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = {
    "daily_ty": lambda s: pipeline.staging(s, SF_DIR),
    "daily_ty_ly": lambda s: pipeline.daily(s, SF_DIR),
    "weekly_final": lambda s: pipeline.weekly(s, SF_DIR),
}
BASELINE = {
    "daily_ty_ly_chained": lambda s: pipeline.daily(s, SF_DIR, chained=True),
    "weekly_final_selfjoin": lambda s: pipeline.weekly(s, SF_DIR, form="selfjoin"),
}


def _time(spark, build) -> float:
    t0 = time.perf_counter()
    build(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _exchanges(df) -> int:
    """Shuffle exchanges in the planned (pre-adaptive) physical plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _medians(spark, builds: dict) -> dict[str, float]:
    """Warm each query up once, then time ``RUNS`` rounds, queries interleaved
    within a round so drift (JIT, GC, machine load) does not favour one."""
    for build in builds.values():
        _time(spark, build)
    samples: dict[str, list[float]] = {k: [] for k in builds}
    for _ in range(RUNS):
        for name, build in builds.items():
            samples[name].append(_time(spark, build))
    return {k: round(statistics.median(v), 3) for k, v in samples.items()}


def wide_facts(spark):
    """Stand-in facts keyed by real part and customer numbers, each row also one year (364 days) earlier: entities grow
    with the facts, and about half of the days find a last-year partner."""
    keys = fixtures.table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_linenumber", "l_shipdate")
    orders = fixtures.table(spark, SF_DIR, "orders").select("o_orderkey", "o_custkey")
    rows = keys.join(orders, keys.l_orderkey == orders.o_orderkey)
    day = F.explode(F.array(F.to_date("l_shipdate"), F.date_sub(F.to_date("l_shipdate"), 364))).alias("day")
    q, p, d = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    return rows.select("*", day).select(
        F.lit(1).alias(S.RETAILER), (F.col("l_suppkey") % 3).cast("int").alias(S.VENDOR), F.date_format("day", "yyyyMMdd").cast("int").alias(S.PERIOD),
        F.col("l_partkey").cast("int").alias(S.ITEM), (F.col("o_custkey") % 500).cast("int").alias(S.STORE), F.lit(1).alias(S.OSA_TYPE),
        q.alias("total_units"), p.alias("total_sales"), (q * d).alias("lost_units"), (p * d).alias("lost_sales"),
        (q * 2).alias("retail_on_hand"), (q + q * d).alias("rs_demand"), (q + F.col("l_linenumber")).alias("rs_inventory"),
        (F.col("l_linenumber") * 1.5).alias("osa_duration"),
    )


def stage_timings(spark, wide: bool = False) -> tuple[dict, dict]:
    """Each operator on its own, reading a checkpointed input as the job reads
    stored staging/daily, so the stand-in fact build is not in the timing."""
    cal = pipeline.calendar(spark, SF_DIR)
    win = calendar_window(cal, oracle.AS_OF, oracle.YEARS)
    stg = (build_staging(wide_facts(spark), cal) if wide else pipeline.staging(spark, SF_DIR)).checkpoint(eager=True)
    daily = build_daily(stg, win).checkpoint(eager=True)
    forms = {
        "daily_short": lambda s: build_daily(stg, win),
        "daily_short_union_aggregate": lambda s: build_daily(stg, win, strategy="aggregate"),
        "daily_chained": lambda s: build_daily_chained(stg, win),
        "weekly_one_aggregate": lambda s: build_weekly(daily),
        "weekly_selfjoin": lambda s: build_weekly_joined(daily, selfjoin=True),
    }
    secs = _medians(spark, forms)
    rows = {"staging": stg.count(), "daily": daily.count()}
    return rows, {name: {"sec": secs[name], "exchanges": _exchanges(build(spark))} for name, build in forms.items()}


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS * 2), app="shelfroll-bench")
    medians = _medians(spark, {**HEADLINE, **BASELINE})
    _, stages = stage_timings(spark)
    wide_rows, wide = stage_timings(spark, wide=True)
    fact_rows = pipeline.fact(spark, SF_DIR).count()
    headline = {k: medians[k] for k in HEADLINE}
    baseline = {k: medians[k] for k in BASELINE}
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "pipeline_median_sec",
        "value": round(sum(headline.values()), 3),
        "unit": "sec",
        "queries": headline,
        "baseline": baseline,
        "speedup_vs_baseline": {
            "daily_ty_ly": round(baseline["daily_ty_ly_chained"] / headline["daily_ty_ly"], 2),
            "weekly_final": round(baseline["weekly_final_selfjoin"] / headline["weekly_final"], 2),
        },
        "stages_from_checkpointed_input": stages,
        "wide_key_stages": wide,
        "wide_key_rows": wide_rows,
        "fact_rows": fact_rows,
        "fact_rows_per_sec_staging": round(fact_rows / medians["daily_ty"]),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
