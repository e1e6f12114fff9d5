"""Column names, types and the metric registry shared by every stage.

All names are lower snake case. Keys are typed at read time (``period_key``
int ``yyyyMMdd``, ``week_ended`` date) so no stage ever compares a key with a
string, which Spark's ANSI mode rejects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- keys
RETAILER = "retailer_key"
VENDOR = "vendor_key"
PERIOD = "period_key"
ITEM = "item_key"
STORE = "store_key"
OSA_TYPE = "osa_type_key"
LY_PERIOD = "ly_period_key"
WEEK_ENDED = "week_ended"
X_WEEK_ENDED = "x_week_ended"
TY_YEAR_WEEK = "ty_year_week"

#: the five entity keys shared by every grain
K5 = [RETAILER, VENDOR, ITEM, STORE, OSA_TYPE]
#: the daily grain
K6 = [RETAILER, VENDOR, PERIOD, ITEM, STORE, OSA_TYPE]
#: the weekly grain
WEEK_KEYS = [RETAILER, VENDOR, WEEK_ENDED, STORE, ITEM, OSA_TYPE]

#: hive-style output layouts
DAILY_PARTITIONS = [VENDOR, PERIOD]
WEEKLY_PARTITIONS = [VENDOR, WEEK_ENDED]


# ---------------------------------------------------------------- metrics
@dataclass(frozen=True)
class Metric:
    """One fact measure and how each roll-up treats it.

    ``daily`` is the fact → day aggregate (``sum`` or ``avg``); ``weekly`` is
    the day → week treatment (``sum``, ``avg`` or ``last_positive``: the value
    of the latest day in the week whose TY value is > 0). ``scale`` is the
    number of decimals the daily grain carries exactly: sums of cent-rounded
    inputs have 2, daily averages are rounded to 6.
    """

    name: str
    daily: str
    weekly: str
    scale: int

    @property
    def ty(self) -> str:
        return f"{self.name}_ty"

    @property
    def ly(self) -> str:
        return f"{self.name}_ly"


# The eight fact measures and their roll-up rules, in the order
# the final tables list them.
METRICS: list[Metric] = [
    Metric("total_units", "sum", "sum", 2),
    Metric("total_sales", "sum", "sum", 2),
    Metric("lost_units", "sum", "sum", 2),
    Metric("lost_sales", "sum", "sum", 2),
    Metric("rs_demand", "sum", "sum", 2),
    Metric("retail_on_hand", "sum", "last_positive", 2),
    Metric("rs_inventory", "sum", "last_positive", 2),
    Metric("osa_duration", "avg", "avg", 6),
]
METRIC_BY_NAME = {m.name: m for m in METRICS}

#: raw fact measures are rounded to this many decimals before aggregation
INPUT_SCALE = 2

TY_METRICS = [m.ty for m in METRICS]
LY_METRICS = [m.ly for m in METRICS]
#: the 16 metric columns of the daily and weekly tables
FINAL_METRICS = TY_METRICS + LY_METRICS

# ---------------------------------------------------------------- layouts
FACT_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType(), False) for k in K6]
    + [T.StructField(m.name, T.DoubleType(), True) for m in METRICS]
)

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField(PERIOD, T.IntegerType(), False),
        T.StructField(LY_PERIOD, T.IntegerType(), True),
        T.StructField(WEEK_ENDED, T.DateType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("year_week", T.IntegerType(), True),
    ]
)

STAGING_COLUMNS = K6 + TY_METRICS + [LY_PERIOD, TY_YEAR_WEEK, WEEK_ENDED]
DAILY_COLUMNS = [RETAILER, VENDOR, PERIOD, WEEK_ENDED, ITEM, STORE, OSA_TYPE] + FINAL_METRICS + [LY_PERIOD]
WEEKLY_COLUMNS = WEEK_KEYS + FINAL_METRICS + [X_WEEK_ENDED]


def _typed(cols: list[str]) -> T.StructType:
    types = {
        **{k: T.IntegerType() for k in K6 + [LY_PERIOD, TY_YEAR_WEEK]},
        WEEK_ENDED: T.DateType(),
        X_WEEK_ENDED: T.DateType(),
        **{c: T.DoubleType() for c in FINAL_METRICS},
    }
    return T.StructType([T.StructField(c, types[c], True) for c in cols])


STAGING_SCHEMA = _typed(STAGING_COLUMNS)
DAILY_SCHEMA = _typed(DAILY_COLUMNS)
WEEKLY_SCHEMA = _typed(WEEKLY_COLUMNS)

# Job parameter document fields (15), in document order.
PARAM_FIELDS = [
    "aggregateBaseUri",
    "aggregationLevel",
    "aggregationType",
    "retailer",
    "vendors",
    "jobId",
    "factBaseUri",
    "dimBaseUri",
    "calendarId",
    "osaFactBaseURI",
    "subject",
    "loadType",
    "dateRange",
    "kafkaServer",
    "kafkaTopic",
]

PARAMS_SCHEMA = T.StructType(
    [
        T.StructField(
            f,
            T.IntegerType() if f == "jobId" else T.ArrayType(T.IntegerType()) if f == "vendors" else T.StringType(),
            True,
        )
        for f in PARAM_FIELDS
    ]
)

# Run-log layout.
JOB_LOG_SCHEMA = T.StructType(
    [
        T.StructField("JobId", T.IntegerType(), True),
        T.StructField("JobStep", T.StringType(), True),
        T.StructField("JobDescription", T.StringType(), True),
        T.StructField("StartTime", T.StringType(), True),
        T.StructField("Status", T.StringType(), True),
    ]
)
