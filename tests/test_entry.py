from __future__ import annotations

import pytest

import __spark_entry__ as entry
from shelfroll import schema as S
from shelfroll.plans.queries import REGISTRY
from shelfroll.session import ensure_checkpoint_dir


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == S.DAILY_COLUMNS
    assert df.count() > 0


def test_every_query_of_the_job_has_an_oracle():
    qs, sql = set(REGISTRY), entry.oracle_sql()
    assert set(sql) <= set(entry.queries()) and qs <= set(entry.queries())
    assert qs <= set(sql)
    for name in ("daily_ty", "daily_ty_ly", "weekly_final", "calendar_dim", "fact_scan", "str_clean_list"):
        assert name in qs


def test_a_missing_checkpoint_folder_is_an_error():
    class Unset:
        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Unset())


def test_some_queries_match_duckdb_at_smoke_scale(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("daily_ty_ly", "weekly_final", "last_nonempty_inventory", "group_agg_generic"):
        sdf = entry.queries()[name](spark, sf)
        cols = sorted(sdf.columns)
        got = sorted(repr(tuple(r[c] for c in cols)) for r in sdf.collect())
        res = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in res.description]
        want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in res.fetchall())
        assert got == want, name
