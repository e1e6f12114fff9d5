"""Job parameters from a multi-line JSON document.

The document must hold exactly one object with exactly the 15 known fields;
anything else raises :class:`JobParamsError` (no failure flags, no partial
results). String values lose ``[`` and ``]`` except ``dimBaseUri`` and
``dateRange``; ``dateRange`` is ``"end,start"`` in ``yyyyMMdd``; ``vendors``
is a list of ints (a JSON array, or list text such as ``"[1, 2]"``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .. import schema as S

# The load types a job accepts.
LOAD_TYPES = ("FL", "IL", "FR", "IR")
_KEEP_BRACKETS = {"dimBaseUri", "dateRange"}


class JobParamsError(ValueError):
    """The parameter document is missing, malformed or incomplete.

    ``log_path`` is the job's log folder, if the document is good enough to name it.
    """

    log_path: str | None = None


def strip_brackets(s: str) -> str:
    return s.replace("[", "").replace("]", "")


def clean_list(s: str) -> list[str]:
    """Same rule as ``functions.strings.clean_list``, for one driver-side value."""
    items = "".join(ch for ch in strip_brackets(s) if not ch.isspace()).split(",")
    while items and items[-1] == "" and len(items) > 1:
        items.pop()
    if items == [""] and "," in s:
        return []
    return items


@dataclass(frozen=True)
class JobParams:
    aggregate_base_uri: str
    aggregation_level: str
    aggregation_type: str
    retailer: str
    vendors: list[int]
    job_id: int
    fact_base_uri: str
    dim_base_uri: str
    calendar_id: str
    osa_fact_base_uri: str
    subject: str
    load_type: str
    start: int
    end: int
    kafka_server: str = ""
    kafka_topic: str = ""
    raw: dict = field(default_factory=dict, compare=False, repr=False)

    # dataset locations, all below the URIs the document names
    @property
    def fact_path(self) -> str:
        return f"{self.osa_fact_base_uri.rstrip('/')}/{self.retailer}/{self.subject}/"

    @property
    def dim_base(self) -> str:
        return self.dim_base_uri or self.osa_fact_base_uri

    def output_path(self, what: str) -> str:
        return f"{self.aggregate_base_uri.rstrip('/')}/{self.retailer}/{what}/"

    @property
    def staging_path(self) -> str:
        return self.output_path("staging")

    @property
    def daily_path(self) -> str:
        return self.output_path("daily")

    @property
    def weekly_path(self) -> str:
        return self.output_path("weekly")

    @property
    def week_state_path(self) -> str:
        return self.output_path("weekly_state")

    @property
    def log_path(self) -> str:
        return self.output_path("job_logs")


def parse_date_range(text: str) -> tuple[int, int]:
    """``"end,start"`` → ``(start, end)`` as int keys; start must not exceed end."""
    parts = [p for p in clean_list(text) if p]
    if len(parts) != 2 or not all(p.isdigit() and len(p) == 8 for p in parts):
        raise JobParamsError(f"dateRange must be 'end,start' in yyyyMMdd, got {text!r}")
    end, start = int(parts[0]), int(parts[1])
    if start > end:
        raise JobParamsError(f"dateRange start {start} is after end {end}")
    return start, end


def _vendors(v) -> list[int]:
    if v is None:
        raise JobParamsError("vendors is missing")
    items = v if isinstance(v, list) else clean_list(str(v))
    try:
        out = [int(x) for x in items if str(x).strip() != ""]
    except (TypeError, ValueError) as e:
        raise JobParamsError(f"vendors must be integers, got {v!r}") from e
    if not out:
        raise JobParamsError("vendors is empty")
    return out


def params_from_dict(doc: dict) -> JobParams:
    missing = [f for f in S.PARAM_FIELDS if f not in doc]
    extra = [f for f in doc if f not in S.PARAM_FIELDS]
    if missing or extra:
        raise JobParamsError(f"expected the {len(S.PARAM_FIELDS)} known fields; missing={missing} unknown={extra}")

    def text(name: str) -> str:
        v = doc[name]
        s = "" if v is None else (",".join(str(x) for x in v) if isinstance(v, list) else str(v))
        return s if name in _KEEP_BRACKETS else strip_brackets(s)

    load_type = text("loadType").strip()
    if load_type not in LOAD_TYPES:
        raise JobParamsError(f"unknown load type {load_type!r}; expected one of {LOAD_TYPES}")
    try:
        job_id = int(strip_brackets(str(doc["jobId"])))
    except ValueError as e:
        raise JobParamsError(f"jobId must be an integer, got {doc['jobId']!r}") from e
    start, end = parse_date_range(text("dateRange"))
    return JobParams(
        aggregate_base_uri=text("aggregateBaseUri"),
        aggregation_level=text("aggregationLevel"),
        aggregation_type=text("aggregationType"),
        retailer=text("retailer"),
        vendors=_vendors(doc["vendors"]),
        job_id=job_id,
        fact_base_uri=text("factBaseUri"),
        dim_base_uri=text("dimBaseUri"),
        calendar_id=text("calendarId"),
        osa_fact_base_uri=text("osaFactBaseURI"),
        subject=text("subject"),
        load_type=load_type,
        start=start,
        end=end,
        kafka_server=text("kafkaServer"),
        kafka_topic=text("kafkaTopic"),
        raw=dict(doc),
    )


def read_params(spark: SparkSession, path: str) -> JobParams:
    """Read and validate the parameter document at ``path`` (any Spark-readable URI).

    The document is read as text by Spark (so cluster file systems work) and
    parsed on the driver; it is one small object, never data.
    """
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise JobParamsError(f"expected one parameter file at {path}, found {'none' if not rows else 'several'}")
    try:
        doc = json.loads(rows[0][0])
    except json.JSONDecodeError as e:
        raise JobParamsError(f"parameter file is not valid JSON: {e}") from e
    if isinstance(doc, list):
        if len(doc) != 1:
            raise JobParamsError(f"expected exactly one parameter object, found {len(doc)}")
        doc = doc[0]
    if not isinstance(doc, dict):
        raise JobParamsError("parameter document must be a JSON object")
    try:
        return params_from_dict(doc)
    except JobParamsError as e:
        base, retailer = (strip_brackets(str(doc.get(f) or "")) for f in ("aggregateBaseUri", "retailer"))
        if base and retailer:
            e.log_path = f"{base.rstrip('/')}/{retailer}/job_logs/"
        raise


def params_frame(spark: SparkSession, path: str):
    """The typed one-row DataFrame view of the document (multi-line JSON)."""
    return spark.read.schema(S.PARAMS_SCHEMA).option("multiLine", True).json(path)
