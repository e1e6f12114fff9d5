"""Typed scans of the job's datasets.

Every reader takes an explicit schema, so keys come back typed (``period_key``
int, ``week_ended`` date) even for hive-style partition directories, and
range/vendor arguments become ``PartitionFilters`` on the Parquet scan: files
outside the requested partitions are never opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schema as S
from ..operators.calendar import as_key, period_between
from .storage import listing, resolved

# Dimension folder names below ``<base><retailer>/dim_data/``.
DIM_FOLDERS = {
    "item": "item",
    "store": "store",
    "calendar": "calendar",
    "osa_class": "osa_classification",
}


def dim_path(base: str, retailer: str, dim: str) -> str:
    return f"{base.rstrip('/')}/{retailer}/dim_data/{DIM_FOLDERS[dim]}/"


def read_dim(spark: SparkSession, base: str, retailer: str, dim: str, schema: StructType | None = None) -> DataFrame:
    """Scan one dimension dataset (Parquet)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(dim_path(base, retailer, dim))


def read_dataset(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The partitioned dataset at ``path``, listed once."""
    with listing(spark):
        return spark.read.schema(schema).parquet(resolved(spark, path))


def read_calendar(spark: SparkSession, base: str, retailer: str) -> DataFrame:
    return read_dim(spark, base, retailer, "calendar", S.CALENDAR_SCHEMA)


def read_dim_item(spark: SparkSession, base: str, retailer: str) -> DataFrame:
    return read_dim(spark, base, retailer, "item")


def read_dim_store(spark: SparkSession, base: str, retailer: str) -> DataFrame:
    return read_dim(spark, base, retailer, "store")


def read_dim_osa_class(spark: SparkSession, base: str, retailer: str) -> DataFrame:
    return read_dim(spark, base, retailer, "osa_class")


def _restrict(
    df: DataFrame, vendors: Sequence[int] | None, start, end, col: str = S.PERIOD
) -> DataFrame:
    if vendors is not None:
        df = df.where(F.col(S.VENDOR).isin([int(v) for v in vendors]))
    if start is not None or end is not None:
        if col == S.WEEK_ENDED:
            cond = F.lit(True)
            if start is not None:
                cond = cond & (F.col(col) >= F.to_date(F.lit(str(as_key(start))), "yyyyMMdd"))
            if end is not None:
                cond = cond & (F.col(col) <= F.to_date(F.lit(str(as_key(end))), "yyyyMMdd"))
            df = df.where(cond)
        else:
            df = df.where(period_between(start, end, col))
    return df


def read_fact(
    spark: SparkSession, path: str, vendors: Sequence[int] | None = None, start=None, end=None
) -> DataFrame:
    """Raw facts below ``path`` (``vendor_key=…/period_key=…``), 14 typed columns."""
    df = read_dataset(spark, path, S.FACT_SCHEMA)
    return _restrict(df, vendors, start, end).select(*[f.name for f in S.FACT_SCHEMA.fields])


def read_staging(spark: SparkSession, path: str, start=None, end=None, vendors: Sequence[int] | None = None) -> DataFrame:
    df = read_dataset(spark, path, S.STAGING_SCHEMA)
    return _restrict(df, vendors, start, end).select(*S.STAGING_COLUMNS)


def read_daily(spark: SparkSession, path: str, start=None, end=None, vendors: Sequence[int] | None = None) -> DataFrame:
    df = read_dataset(spark, path, S.DAILY_SCHEMA)
    return _restrict(df, vendors, start, end).select(*S.DAILY_COLUMNS)


def read_weekly(
    spark: SparkSession, path: str, start=None, end=None, vendors: Sequence[int] | None = None
) -> DataFrame:
    """Weekly table; ``start``/``end`` bound ``week_ended``."""
    df = read_dataset(spark, path, S.WEEKLY_SCHEMA)
    return _restrict(df, vendors, start, end, col=S.WEEK_ENDED).select(*S.WEEKLY_COLUMNS)
