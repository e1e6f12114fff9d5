"""Step log of a job run.

Steps are made on the driver (a handful per run, never data) and handed to
``keep`` one by one when they happen, which appends them to the stored log: a
job that is killed leaves the steps it got to. Logs of several runs or stages
combine with a bag union, and :func:`latest_status` reads a stored log back as
the last state of every stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Step statuses.
SUCCESS = "Success"
IN_PROGRESS = "In-Progress"
FAILED = "Failed"


def stamp(now: dt.datetime | None = None) -> str:
    """``yyyy-MM-dd HH:mm:ss`` (minutes and seconds in their places)."""
    return (now or dt.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class RunLog:
    job_id: int | None
    rows: list[tuple] = field(default_factory=list)
    clock: object = None  # callable returning datetime; tests pin it
    keep: Callable[[RunLog], None] | None = None  # takes a log of the one new step

    def add(self, description: str, status: str = SUCCESS) -> None:
        now = self.clock() if callable(self.clock) else None
        self.rows.append((self.job_id, f"Step {len(self.rows) + 1}", description, stamp(now), status))
        if self.keep is not None:
            self.keep(RunLog(self.job_id, self.rows[-1:]))

    @property
    def failed(self) -> bool:
        return any(r[4] == FAILED for r in self.rows)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, S.JOB_LOG_SCHEMA)


def union_logs(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; duplicates are kept."""
    if not frames:
        raise ValueError("union_logs needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def latest_status(log: DataFrame) -> DataFrame:
    """(JobId, stage, JobStep, JobDescription, StartTime, Status): the last step of every stage of every job.

    The stage is the first word of the description (Parameters, Staging,
    Daily, Weekly). Steps count up within a run and later runs start later, so
    the last step is that of the latest time and the highest number. A stage
    whose job was killed shows In-Progress; a null job id is a job of its own.
    """
    number = F.regexp_extract("JobStep", "([0-9]+)$", 1).try_cast("int")
    columns = ["JobStep", "JobDescription", "StartTime", "Status"]
    stage = F.substring_index("JobDescription", " ", 1)
    last = F.max_by(F.struct(*columns), F.struct(F.coalesce("StartTime", F.lit("")), F.coalesce(number, F.lit(0))))
    return log.groupBy("JobId", stage.alias("stage")).agg(last.alias("last")).select("JobId", "stage", "last.*")
