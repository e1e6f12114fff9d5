"""Command-line entry: ``python -m shelfroll <params.json> [--as-of yyyy-MM-dd] [--years N]``
(``scripts/run_job.py`` is the same entry as a file for ``spark-submit``).

Uses the session ``spark-submit`` provides (``getOrCreate``); nothing about
the cluster is configured here. Exit code 0 on success, 1 when the job or its
parameters fail (the run log has the failed step).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.jobs import run_from_file


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shelfroll", description=__doc__)
    ap.add_argument("params", help="path or URI of the JSON job parameters")
    ap.add_argument("--as-of", default=None, help="day the calendar window ends before (default: today)")
    ap.add_argument("--years", type=int, default=3, help="calendar window length in years")
    ap.add_argument("--log-path", default=None, help="where to log a rejected parameter file")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("shelfroll").getOrCreate()
    try:
        log = run_from_file(spark, args.params, as_of=args.as_of, years=args.years, log_path=args.log_path)
    except Exception as e:  # the run log already holds the failure
        print(f"shelfroll: job failed: {type(e).__name__}: {e}", file=sys.stderr)
        return 1
    for row in log.rows:
        print(" | ".join("" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
