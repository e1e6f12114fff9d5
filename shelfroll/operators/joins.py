"""Skew-safe join keys.

Small dimensions (the calendar has one row per day) are joined plainly: the
planner broadcasts them from their file statistics or at run time (AQE), and
shuffles them where they have grown beyond its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_key_salt(keys: list[str], payload: list[str]) -> Column:
    """0 for rows whose join keys are all non-null; a row hash otherwise.

    Added as an extra equi-join key, it leaves matching unchanged (null keys
    never match anyway) but spreads rows with null keys over all shuffle
    partitions instead of hashing every one of them to the same partition.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return F.when(any_null, F.xxhash64(*[F.col(c) for c in keys + payload])).otherwise(F.lit(0).cast("long"))
