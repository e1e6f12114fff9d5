"""Print the physical plans of the job path (what a cluster run executes).

usage: python scripts/show_plans.py [sf_dir]

Writes the stand-in staging through the library's sink, then shows
``explain("formatted")`` for: daily TY/LY over one month read from stored
staging, and weekly read from stored daily, plus a one-line summary of
exchanges, broadcasts, joins and scan filters for each.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfroll.operators.calendar import calendar_window  # noqa: E402
from shelfroll.operators.compare import build_daily  # noqa: E402
from shelfroll.operators.weekly import build_weekly  # noqa: E402
from shelfroll.plans import oracle, pipeline, sinks  # noqa: E402
from shelfroll.session import local_session, scratch_path  # noqa: E402
from shelfroll.sources.tables import read_daily, read_staging  # noqa: E402


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    return (
        f"hash exchanges={plan.count('Exchange hashpartitioning')} "
        f"broadcasts={plan.count('BroadcastExchange')} "
        f"sort-merge joins={plan.count('SortMergeJoin')} "
        f"broadcast joins={plan.count('BroadcastHashJoin')} "
        f"partition filters={filters}"
    )


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(4)
    cal = pipeline.calendar(spark, sf)
    window = calendar_window(cal, oracle.AS_OF, oracle.YEARS)
    stg_path = scratch_path(spark, "plans-staging")
    sinks.write_staging(pipeline.staging(spark, sf), stg_path, "full")
    daily = build_daily(read_staging(spark, stg_path), window, 20000101, 20000131)
    print("### daily TY/LY, January 2000, from stored staging\n")
    print(summary(daily) + "\n")
    daily.explain("formatted")
    daily_path = scratch_path(spark, "plans-daily")
    sinks.write_daily(build_daily(read_staging(spark, stg_path), window), daily_path, "full")
    weekly = build_weekly(read_daily(spark, daily_path, 20000102, 20000205))
    print("### weekly, five whole weeks, from stored daily\n")
    print(summary(weekly) + "\n")
    weekly.explain("formatted")


if __name__ == "__main__":
    main()
