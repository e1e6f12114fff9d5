"""File-system steps a DataFrame writer has no call for, and how datasets are listed, replaced and found.

They go through Hadoop's FileSystem, so they reach whatever store Spark
itself reads (local, HDFS, object stores). Only paths pass the driver.

A dataset is replaced in three steps, with a marker file beside it as the
commit point: the complete new dataset is written under another name, the
marker ``<path>__swap`` names it (from here on it *is* the table, and readers
that ask :func:`resolved` get it), then the folders are renamed and the marker
goes. Whenever a job is killed, one complete dataset is readable, and the next
writer finishes the open swap.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DISCOVERY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; the folders above it are made."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    target = _fs(spark, new)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"could not rename {old} to {new}")


def _file_count(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getFileCount())


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}__swap"


def _write_marker(spark: SparkSession, path: str, new: str, files: int) -> None:
    """Names the new dataset; the file is complete when it gets its name."""
    fs, p = _fs(spark, f"{_marker(path)}-{new.rsplit('/', 1)[-1]}")
    out = fs.create(p, True)
    out.writeBytes(f"{new.rsplit('/', 1)[-1]}\t{files}")
    out.close()
    rename(spark, p.toString(), _marker(path))


def _open_swap(spark: SparkSession, path: str) -> str | None:
    """The complete new dataset an open swap names; None where there is none or its files have all been moved."""
    if not exists(spark, _marker(path)):
        return None
    name, files = spark.read.text(_marker(path)).first()[0].split("\t")
    new = f"{path.rstrip('/').rsplit('/', 1)[0]}/{name}"
    # a store that renames by copying deletes the source once all is copied: with files missing, ``path`` is complete
    return new if exists(spark, new) and _file_count(spark, new) >= int(files) else None


def resolved(spark: SparkSession, path: str) -> str:
    """The folder that holds the dataset of ``path`` just now."""
    return _open_swap(spark, path) or path


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished dataset ``new`` (beside ``path``) in the place of ``path``."""
    finish_swap(spark, path)
    path, new = path.rstrip("/"), new.rstrip("/")
    _write_marker(spark, path, new, _file_count(spark, new))
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Does what is left of an open swap; nothing where none is open. Writers call it before they touch a dataset."""
    marker = _marker(path)
    if not exists(spark, marker):
        return
    new = _open_swap(spark, path)
    if new is not None:
        delete(spark, path)  # the old dataset: the marker has named its successor
        rename(spark, new, path)
    delete(spark, marker)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a dataset, an open swap included."""
    new = _open_swap(spark, path)
    for folder in (_marker(path), path, *([new] if new else [])):
        delete(spark, folder)


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """While datasets are listed: two tasks a core at most. Spark's default is a task per directory up to 10,000,
    which costs more than the listing where directories are many and cores few."""
    before = spark.conf.get(_DISCOVERY)
    spark.conf.set(_DISCOVERY, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_DISCOVERY, before)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: ``path``, ``length`` and the partition columns, no file opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false").option("pathGlobFilter", "*.parquet")
    with listing(spark):
        return reader.load(resolved(spark, path)).drop("content", "modificationTime")
