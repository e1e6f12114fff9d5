from __future__ import annotations

import hashlib
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfroll import schema as S
from shelfroll.plans import sinks
from shelfroll.session import ensure_checkpoint_dir
from shelfroll.sources import storage
from shelfroll.sources.partitions import partition_list
from shelfroll.sources.tables import read_staging

from .conftest import staging_rows


def _files(root: str) -> dict[str, str]:
    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[os.path.relpath(p, root)] = hashlib.md5(open(p, "rb").read()).hexdigest()
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _stg(spark, scale=1.0):
    rows = []
    for v in (1, 2):
        for p in (20000103, 20000104, 20000105):
            rows.append({"vendor_key": v, "period_key": p, "total_units_ty": scale * (v * 10 + p % 10)})
    return staging_rows(spark, rows)


def test_full_write_is_idempotent_and_typed(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    df = _stg(spark)
    sinks.write_staging(df, path, "full")
    first = _rows(read_staging(spark, path))
    sinks.write_staging(df, path, "full")
    assert _rows(read_staging(spark, path)) == first == _rows(df.select(*S.STAGING_COLUMNS))
    back = read_staging(spark, path)
    assert back.schema[S.PERIOD].dataType.typeName() == "integer"
    assert back.schema[S.WEEK_ENDED].dataType.typeName() == "date"
    assert sorted(os.listdir(path))[-2:] == ["vendor_key=1", "vendor_key=2"]


def test_upsert_touches_only_its_partitions(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    before = _files(path)
    # new values for vendor 1, period 20000104 only
    patch = _stg(spark, scale=2.0).where((F.col(S.VENDOR) == 1) & (F.col(S.PERIOD) == 20000104))
    sinks.write_staging(patch, path, "upsert")
    after = _files(path)
    touched = {k for k in after if k.startswith("vendor_key=1/period_key=20000104/")}
    assert touched and all(k not in before for k in touched)
    for k, h in before.items():
        if not k.startswith("vendor_key=1/period_key=20000104/"):
            assert after[k] == h  # byte for byte
    got = {(r[S.VENDOR], r[S.PERIOD]): r["total_units_ty"] for r in read_staging(spark, path).collect()}
    assert got[(1, 20000104)] == 2.0 * 14 and got[(1, 20000103)] == 13 and got[(2, 20000104)] == 24
    assert len(got) == 6


def test_full_overwrite_removes_stale_partitions(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    sinks.write_staging(_stg(spark).where(F.col(S.VENDOR) == 2), path, "full")
    assert {r[S.VENDOR] for r in read_staging(spark, path).collect()} == {2}
    assert not os.path.exists(os.path.join(path, "vendor_key=1"))


def test_range_read_prunes_partitions(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    df = read_staging(spark, path, 20000104, 20000105, vendors=[2])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower() or "period_key" in plan
    assert {(r[S.VENDOR], r[S.PERIOD]) for r in df.collect()} == {(2, 20000104), (2, 20000105)}


def test_orc_save_modes_and_preview(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/log"
    df = spark.createDataFrame([(1, "Step 1", "x", "t", "Success")], S.JOB_LOG_SCHEMA)
    sinks.save_orc(path, df, overwrite=False)
    sinks.save_orc(path, df, overwrite=False)
    assert spark.read.orc(path).count() == 2
    sinks.save_orc(path, df, overwrite=True)
    assert spark.read.orc(path).count() == 1
    p = sinks.preview(_stg(spark), S.K6, 2).collect()
    assert [(r[S.VENDOR], r[S.PERIOD]) for r in p] == [(1, 20000103), (1, 20000104)]


def test_bad_mode_rejected(spark):
    try:
        sinks.write_partitioned(_stg(spark), "/nonexistent/x", S.DAILY_PARTITIONS, "append")
    except ValueError:
        return
    raise AssertionError("append mode must be rejected")


def test_an_append_writer_fails_the_upsert_query(spark, monkeypatch):
    """The registered upsert query must not pass for a writer that appends."""
    from shelfroll.plans import queries as Q

    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    df = _stg(spark)
    monkeypatch.setattr(Q, "scratch_path", lambda *_: path)
    in_year = F.lit(True)
    good = Q._upsert_round_trip(spark, df, sinks.write_staging, read_staging, "total_units_ty", in_year)
    assert _rows(good) == _rows(df.select(*S.STAGING_COLUMNS))

    def append(frame, where, mode):
        frame.select(*S.STAGING_COLUMNS).write.partitionBy(*S.DAILY_PARTITIONS).mode("overwrite" if mode == "full" else "append").parquet(where)

    bad = Q._upsert_round_trip(spark, df, append, read_staging, "total_units_ty", in_year)
    assert _rows(bad) != _rows(df.select(*S.STAGING_COLUMNS))


def test_upsert_with_a_scope_removes_what_the_frame_lacks(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    part = _stg(spark).where((F.col(S.VENDOR) == 1) & (F.col(S.PERIOD) == 20000103)).select(*S.STAGING_COLUMNS)
    scope = sinks.vendor_scope([1]) & (F.col(S.PERIOD) <= 20000104)
    before = _files(path)
    done = sinks.write_staging(part, path, "upsert", scope)
    assert (done.rows, done.directories, done.removed) == (1, 1, 1)
    left = {(r[S.VENDOR], r[S.PERIOD]) for r in read_staging(spark, path).collect()}
    assert left == {(1, 20000103), (1, 20000105), (2, 20000103), (2, 20000104), (2, 20000105)}
    after = _files(path)
    assert all(after[k] == h for k, h in before.items() if "vendor_key=2" in k or "20000105" in k)
    # a frame without rows empties its scope and nothing else
    done = sinks.write_staging(part.limit(0), path, "upsert", sinks.vendor_scope([2]))
    assert (done.rows, done.removed) == (0, 3)
    assert {r[S.VENDOR] for r in read_staging(spark, path).collect()} == {1}


def test_a_scope_needs_an_upsert(spark):
    with pytest.raises(ValueError, match="scope"):
        sinks.write_staging(_stg(spark), "/nonexistent/x", "full", F.lit(True))


def _tasks(df):
    """Rows and directories of each task."""
    cols = [F.spark_partition_id().alias("task"), *S.DAILY_PARTITIONS]
    out = {}
    for r in df.groupBy(*cols).count().collect():
        out.setdefault(r["task"], {})[(r[S.VENDOR], r[S.PERIOD])] = r["count"]
    return out


def _many(spark, directories, rows_of_first):
    first = spark.range(rows_of_first).select(F.lit(1).alias(S.VENDOR), F.lit(0).alias(S.PERIOD), F.lit("same row").alias("x"))
    rest = spark.range(directories - 1).select(F.lit(2).alias(S.VENDOR), (F.col("id") + 1).cast("int").alias(S.PERIOD), F.lit("x").alias("x"))
    return first.unionByName(rest)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_directories_are_dealt_to_tasks_by_their_rows(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        with sinks.spooled(_many(spark, 400, 1000)) as rows:
            per = rows.groupBy(*S.DAILY_PARTITIONS).agg(F.count("*").alias("n"))
            # one directory holds most rows, all of them alike: it is split all the same
            out, n, directories = sinks.dealt(rows, S.DAILY_PARTITIONS, per, task_rows=100)
            assert (n, directories) == (1399, 400)
            tasks = _tasks(out)
            assert sum(sum(t.values()) for t in tasks.values()) == 1399
            large = [t[(1, 0)] for t in tasks.values() if (1, 0) in t]
            assert len(large) >= 4 and max(large) <= 500
            # without a large one, small directories are packed over all cores, each in one task
            out, _, _ = sinks.dealt(rows, S.DAILY_PARTITIONS, per, task_rows=10_000_000)
            tasks = _tasks(out)
            cores = spark.sparkContext.defaultParallelism
            assert cores < len(tasks) <= 2 * cores
            assert sum(len(t) for t in tasks.values()) == 400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_large_directory_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_ROWS", 100)
    monkeypatch.setattr(sinks.dealt, "__defaults__", (100,))
    path = tempfile.mkdtemp(prefix="sinks-") + "/t"
    done = sinks.write_partitioned(_many(spark, 5, 1000), path, S.DAILY_PARTITIONS, "full")
    assert (done.rows, done.directories) == (1004, 5)
    assert len([k for k in _files(path) if k.startswith("vendor_key=1/")]) >= 4
    assert spark.read.parquet(path).count() == 1004


def test_null_partition_values_keep_their_rows(spark):
    path = tempfile.mkdtemp(prefix="sinks-") + "/t"
    df = spark.createDataFrame([(None, 1, "a"), (None, None, "b"), (1, 1, "c")], "vendor_key int, period_key int, x string")
    for _ in range(2):
        assert sinks.write_partitioned(df, path, S.DAILY_PARTITIONS, "full").rows == 3
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_scratch_rows_go_when_the_write_ends(spark):
    base = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "scratch")
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    assert not [n for n in os.listdir(base) if n.startswith("rows-")]


STOPS = ["_write_marker", "delete", "rename"]


@pytest.mark.parametrize("stop", STOPS)
def test_a_swap_killed_at_any_step_leaves_a_readable_table(spark, monkeypatch, stop):
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    old = _rows(read_staging(spark, path))
    new = _rows(_stg(spark, 3.0).select(*S.STAGING_COLUMNS))
    true = getattr(storage, stop)

    class Killed(BaseException):
        pass

    def fail(spark, *args):
        # the swap's own deletion and renames, not those of scratch folders
        if stop != "delete" or args[0] == path:
            if stop == "rename" and args[1] != path:
                return true(spark, *args)
            raise Killed
        return true(spark, *args)

    monkeypatch.setattr(storage, stop, fail)
    with pytest.raises(Killed):
        sinks.write_staging(_stg(spark, 3.0), path, "full")
    monkeypatch.undo()
    got = _rows(read_staging(spark, path))
    assert got == (old if stop == "_write_marker" else new)
    assert {r[S.PERIOD] for r in partition_list(spark, path).collect()} == {20000103, 20000104, 20000105}
    # the next writer finishes the open swap, an upsert included
    patch = _stg(spark, 5.0).where(F.col(S.VENDOR) == 1)
    sinks.write_staging(patch, path, "upsert")
    assert not os.path.exists(f"{path}__swap")
    want = {r[S.VENDOR]: r["total_units_ty"] for r in read_staging(spark, path).where("period_key = 20000103").collect()}
    assert want == {1: 5.0 * 13, 2: 23.0 if stop == "_write_marker" else 3.0 * 23}


def test_a_copying_store_killed_while_it_deletes_the_source(spark):
    """A rename that copies: all files are at the target, some still at the source. The target counts."""
    path = tempfile.mkdtemp(prefix="sinks-") + "/stg"
    sinks.write_staging(_stg(spark), path, "full")
    new = f"{path}__new-1"
    sinks.write_staging(_stg(spark, 2.0), new, "full")
    storage._write_marker(spark, path, new, storage._file_count(spark, new))
    assert storage.resolved(spark, path) == new
    shutil.rmtree(path)
    shutil.copytree(new, path)
    shutil.rmtree(f"{new}/vendor_key=1")
    assert storage.resolved(spark, path) == path
    assert _rows(read_staging(spark, path)) == _rows(_stg(spark, 2.0).select(*S.STAGING_COLUMNS))


def test_listing_takes_few_tasks_and_restores_the_setting(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with storage.listing(spark):
        assert int(spark.conf.get(name)) == 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before
