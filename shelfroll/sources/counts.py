"""Row counts from Parquet footers.

A count needs no row: Parquet files state their row count in the footer, and
Spark's file source of the second generation pushes ``count(*)``, grouped by
all partition columns or not at all, down to the footers. That source and the
push-down are off by default and are settings of a session, read when a plan
is optimised; so counts live in a session of their own, derived from the
caller's (same catalog, same executors), and stay lazy there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .storage import listing, resolved

# What a counting session needs.
COUNTING_CONF = {
    "spark.sql.sources.useV1SourceList": "avro,binaryfile,csv,json,kafka,orc,text",  # all file sources but Parquet
    "spark.sql.parquet.aggregatePushdown": "true",
}


def counting_session(spark: SparkSession) -> SparkSession:
    """A session derived from ``spark`` in which counts of Parquet datasets come from footers."""
    own = spark.newSession()
    for name, value in COUNTING_CONF.items():
        own.conf.set(name, value)
    return own


def row_count(session: SparkSession, path: str, schema: StructType, by: list[str] | None = None) -> DataFrame:
    """``row_count`` of the dataset at ``path``, one row; or one per directory with ``by``, all its partition columns.

    ``session`` comes from :func:`counting_session`. An empty dataset counts 0 (no row with ``by``).
    """
    with listing(session):
        rows = session.read.schema(schema).parquet(resolved(session, path))
    if by:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    # pushed-down counts are summed, and the sum over no file is null
    return rows.agg(F.expr("coalesce(nullif(count(1), -1), 0)").alias("row_count"))
