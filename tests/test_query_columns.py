"""Every registered query and its DuckDB oracle expose the same column names."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
from shelfroll.plans.queries import REGISTRY

from .conftest import SF_SMALL

# queries that write stand-in datasets first (checked by scripts/oracle_check.py)
STORAGE = {
    "calendar_dim", "dim_item_scan", "dim_store_scan", "dim_osa_class_scan", "fact_scan", "staging_build",
    "staging_range_scan", "daily_range_scan", "partition_list", "partition_in_range", "sink_staging_full",
    "sink_daily_full", "sink_weekly_full", "sink_staging_upsert", "sink_daily_upsert", "sink_weekly_upsert",
    "job_full_load", "job_incremental_load", "job_full_refresh", "job_incremental_refresh", "sink_job_log",
    "daily_period_slice", "row_count", "job_log_union",
}


def test_column_names_match_oracle(spark):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = entry.queries(), {name: sql for name, (_, sql) in REGISTRY.items()}
    checked = 0
    for name, sql in sqls.items():
        if name in STORAGE:
            continue
        spark_cols = sorted(qs[name](spark, SF_SMALL).columns)
        duck_cols = sorted(d[0] for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
        assert spark_cols == duck_cols, name
        checked += 1
    assert checked >= 35
