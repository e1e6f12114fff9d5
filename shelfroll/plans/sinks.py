"""Writers for the partitioned datasets and the run log.

* ``full``    – replace the whole dataset. The new one is written beside the
  old one and swapped in when it is complete (``sources/storage.py``), so a
  failed or killed load leaves a readable dataset.
* ``upsert``  – overwrite only the partitions present in the frame
  (``partitionOverwriteMode=dynamic`` on the writer, not the session); every
  other partition keeps its files byte for byte. With a ``scope`` (vendors ×
  days the frame answers for) the stored partitions of the scope that the
  frame has no rows for are found by a left anti join ahead of the write and
  removed after it.

All are idempotent: writing the same frame twice leaves the same content.

The frame is first written to a flat table in the shared scratch folder. Its
rows per directory are counted there (the frame itself is computed once), and
directories are dealt to tasks by these counts: many small ones are packed to
a task, counting a directory as ``DIRECTORY_ROWS`` rows, and one with more
than ``TASK_ROWS`` is split evenly by row number. Small outputs with thousands of
directories so use every core, and a directory that holds a third of all rows
doesn't land in one task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import scratch_path
from ..sources import storage
from ..sources.partitions import partition_list

MODES = ("full", "upsert")
#: rows a task writes, about; a directory with more is split
TASK_ROWS = 2_000_000
#: what opening a directory's file costs, in rows
DIRECTORY_ROWS = 20_000


@dataclass(frozen=True)
class Written:
    """What a write did: rows, directories, and stored partitions of the scope it removed."""

    rows: int
    directories: int
    removed: int = 0


@contextmanager
def spooled(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once, into a flat table of the shared scratch folder that goes when the block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        storage.delete(spark, path)


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def dealt(rows: DataFrame, cols: list[str], per: DataFrame, task_rows: int = TASK_ROWS) -> tuple[DataFrame, int, int]:
    """(``rows`` with each directory's rows in the task that writes them, their number, the number of directories).

    ``per`` has the rows ``n`` of every directory. A directory of up to ``task_rows`` goes to the task of its hash; a
    larger one takes tasks of its own, its rows dealt by their number in the stored table.
    """
    big = F.col("n") > task_rows
    pieces = F.ceil(F.col("n") / task_rows)
    total = per.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("directories"),
        F.sum(F.when(big, 0).otherwise(F.col("n") + DIRECTORY_ROWS)).alias("small"),
        F.count_if(~big).alias("small_directories"),
        F.sum(F.when(big, pieces).otherwise(0)).alias("pieces"),
    ).first()
    if not total.directories:
        return rows, 0, 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    few = min(total.small_directories, max(2 * cores, math.ceil(total.small / task_rows)))
    place = F.xxhash64(*[F.col(c).cast("string") for c in cols])
    task = F.pmod(place, F.lit(max(few, 1)))
    if total.pieces:
        large = per.where(big).select(*cols, pieces.alias("_pieces"))
        number = rows.withColumn("_row", F.monotonically_increasing_id())
        joined = number.join(large, _same(number, large, cols), "left").select(*[number[c] for c in number.columns], "_pieces")
        own = F.pmod(F.xxhash64(place, F.pmod("_row", "_pieces")), F.lit(total.pieces)) + few
        out = joined.withColumn("_task", F.when(F.col("_pieces").isNull(), task).otherwise(own).cast("int"))
    else:
        out = rows.withColumn("_task", task.cast("int"))
    return out.repartitionById(few + total.pieces, "_task").select(*rows.columns), total.n, total.directories


def write_rows(rows: DataFrame, path: str, partition_cols: list[str], mode: str, scope: Column | None = None) -> Written:
    """Writes the rows of a stored table (see :func:`spooled`)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if scope is not None and mode != "upsert":
        raise ValueError("a scope goes with an upsert; a full write replaces everything")
    spark = rows.sparkSession
    if mode == "upsert" and not storage.exists(spark, storage.resolved(spark, path)):
        mode, scope = "full", None  # the first rows: nothing to keep, and one rename instead of one per directory
    per = rows.groupBy(*partition_cols).agg(F.count("*").alias("n"))
    storage.finish_swap(spark, path)
    gone = _missing(spark, path, partition_cols, per, scope) if scope is not None else []
    out, n, directories = dealt(rows, partition_cols, per)
    writer = out.write.format("parquet").partitionBy(*partition_cols).mode("overwrite")
    if mode == "upsert":
        if n:
            writer.option("partitionOverwriteMode", "dynamic").save(path)
        for folder in gone:
            storage.delete(spark, f"{path.rstrip('/')}/{folder}")
        return Written(n, directories, len(gone))
    beside = f"{path.rstrip('/')}__new-{uuid.uuid4().hex[:12]}"
    try:
        writer.option("partitionOverwriteMode", "static").save(beside)
    except Exception:
        storage.delete(spark, beside)
        raise
    storage.swap_in(spark, beside, path)
    return Written(n, directories)


def _missing(spark: SparkSession, path: str, cols: list[str], per: DataFrame, scope: Column) -> list[str]:
    """Folders of the scope's stored partitions that ``per`` lacks. Only the names of vanished ones come to the driver."""
    if not storage.exists(spark, path):
        return []
    files = storage.data_files(spark, path)
    if not set(cols) <= set(files.columns):  # no file yet
        return []
    stored = partition_list(spark, path, cols, files).where(scope)
    lost = stored.join(per, _same(stored, per, cols), "left_anti")
    return ["/".join(f"{c}={r[c]}" for c in cols) for r in lost.toLocalIterator()]


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str, scope: Column | None = None) -> Written:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    with spooled(df) as rows:
        return write_rows(rows, path, partition_cols, mode, scope)


def write_staging(df: DataFrame, path: str, mode: str = "upsert", scope: Column | None = None) -> Written:
    """Staging by (vendor, period)."""
    return write_partitioned(df.select(*S.STAGING_COLUMNS), path, S.DAILY_PARTITIONS, mode, scope)


def write_daily(df: DataFrame, path: str, mode: str, scope: Column | None = None) -> Written:
    return write_partitioned(df.select(*S.DAILY_COLUMNS), path, S.DAILY_PARTITIONS, mode, scope)


def write_weekly(df: DataFrame, path: str, mode: str, scope: Column | None = None) -> Written:
    """Weekly by (vendor, week); ``x_week_ended`` keeps the week inside the files."""
    return write_partitioned(df.select(*S.WEEKLY_COLUMNS), path, S.WEEKLY_PARTITIONS, mode, scope)


def save_orc(path: str, df: DataFrame, overwrite: bool) -> None:
    """Plain ORC save: overwrite when asked, else append. Errors propagate."""
    df.write.format("orc").mode("overwrite" if overwrite else "append").save(path)


def append_job_log(df: DataFrame, path: str) -> None:
    save_orc(path, df.select(*[f.name for f in S.JOB_LOG_SCHEMA.fields]).coalesce(1), overwrite=False)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (deterministic, unlike a bare ``show``)."""
    return df.orderBy(*order_by).limit(n)


def vendor_scope(vendors: list[int] | None) -> Column:
    return F.lit(True) if vendors is None else F.col(S.VENDOR).isin([int(v) for v in vendors])
