"""Stand-in datasets written once per session, for the scan and sink queries.

The job reads its inputs from storage (hive-style Parquet). To run those
readers against the test tables, the stand-ins are written below the
session's shared checkpoint folder (``spark.checkpoint.dir``) once per
(session, data folder) and reused, all with the library's own sinks. Staging and daily rows are kept flat as well: daily
is built from the flat staging and weekly from the flat daily, so the facts are joined and rounded once and no stage
opens the thousands of files of the one before. Reading them back also cuts the lineage of later plans. The paths
are remembered per session and data folder: the test tables are read-only, and
a changed folder has another path.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schema as S
from ..operators.calendar import calendar_window
from ..operators.compare import build_daily
from ..operators.weekly import build_weekly
from ..session import scratch_path
from ..sources import fixtures
from ..sources.tables import dim_path
from . import pipeline, sinks
from .oracle import AS_OF, YEARS

# Retailer folder name of the stand-in datasets.
RETAILER = "r1"
SUBJECT = "fact"

_LOCK = threading.RLock()
_PATHS: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


def _write(spark: SparkSession, sf_dir: str, what: str) -> str:
    path = scratch_path(spark, what)
    if what == "fact":
        # <base>/<retailer>/<subject>/vendor_key=…/period_key=…
        path = f"{path}/{RETAILER}/{SUBJECT}/"
        sinks.write_partitioned(fixtures.fact(spark, sf_dir), path, S.DAILY_PARTITIONS, "full")
    elif what == "dims":
        for dim, build in (
            ("calendar", fixtures.calendar),
            ("item", fixtures.dim_item),
            ("store", fixtures.dim_store),
            ("osa_class", fixtures.dim_osa_class),
        ):
            build(spark, sf_dir).write.mode("overwrite").parquet(dim_path(path, RETAILER, dim))
    elif what == "staging_rows":
        pipeline.staging(spark, sf_dir).select(*S.STAGING_COLUMNS).write.parquet(path)
    elif what == "staging":
        sinks.write_rows(_flat(spark, sf_dir, "staging_rows", S.STAGING_SCHEMA), path, S.DAILY_PARTITIONS, "full")
    elif what == "daily_rows":
        window = calendar_window(pipeline.calendar(spark, sf_dir), AS_OF, YEARS)
        daily = build_daily(_flat(spark, sf_dir, "staging_rows", S.STAGING_SCHEMA), window)
        daily.select(*S.DAILY_COLUMNS).write.parquet(path)
    elif what == "daily":
        sinks.write_rows(_flat(spark, sf_dir, "daily_rows", S.DAILY_SCHEMA), path, S.DAILY_PARTITIONS, "full")
    elif what == "weekly":
        sinks.write_weekly(build_weekly(_flat(spark, sf_dir, "daily_rows", S.DAILY_SCHEMA)), path, "full")
    else:
        raise ValueError(f"unknown stand-in {what!r}")
    return path


def _flat(spark: SparkSession, sf_dir: str, what: str, schema: StructType) -> DataFrame:
    """The flat rows a stage's partitioned dataset is written from."""
    return spark.read.schema(schema).parquet(stored(spark, sf_dir, what)).select(*[f.name for f in schema.fields])


def stored(spark: SparkSession, sf_dir: str, what: str) -> str:
    """Path of the stand-in dataset ``what`` for ``sf_dir`` (written on first use)."""
    k = _key(spark, sf_dir, what)
    with _LOCK:
        if k not in _PATHS:
            _PATHS[k] = _write(spark, sf_dir, what)
        return _PATHS[k]
