"""Partition listing and date-range selection as DataFrame operations.

Instead of shelling out to a file-system listing and cutting text, the files
of a hive-style dataset are listed by Spark (one row per file, contents never
read) and their partition values come back as typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dates import in_date_range
from .storage import data_files


def partition_list(spark: SparkSession, path: str, cols: list[str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Distinct partition values (default vendor and period) of the dataset at ``path``, or of its listed ``files``."""
    cols = S.DAILY_PARTITIONS if cols is None else cols
    return (data_files(spark, path) if files is None else files).select(*cols).distinct()


def partition_path(cols: list[str] | None = None) -> Column:
    """``vendor_key=V/period_key=P`` text of each row's partition."""
    cols = S.DAILY_PARTITIONS if cols is None else cols
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("/"))
        parts += [F.lit(f"{c}="), F.col(c).cast("string")]
    return F.concat(*parts)


def partitions_in_range(paths: DataFrame, path_col: str, start, end) -> DataFrame:
    """Rows of ``paths`` whose path ends in a ``yyyyMMdd`` date within [start, end]."""
    return paths.where(in_date_range(path_col, start, end))


def partition_slice(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose partition column ``col`` is one of ``values`` (an upsert's slice)."""
    return df.where(F.col(col).isin(list(values)))
