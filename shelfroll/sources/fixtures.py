"""Stand-in inputs built from the shared test tables.

The job expects an OSA fact table, a retail calendar and three small
dimensions. The test data ships TPC-H-like tables instead, so these builders
only *reshape* those tables into the job's input schemas (mapping documented
in FIXTURES.md §2). They do none of the job's work: no rounding, no
aggregation to the daily grain, no TY/LY matching.

Everything stays a lazy Spark plan; the calendar's day span is derived from
the fact dates (whole years, from the first fact year through the year after
the last one), so it grows with the data instead of being a fixed list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _period_key(d) -> F.Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw store/item/day facts (grain may repeat) from lineitem and its dimensions."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        _period_key(F.col("l_shipdate")).alias(S.PERIOD),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("int").alias(S.OSA_TYPE),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").alias("p"),
        F.col("l_discount").alias("d"),
        F.col("l_linenumber").alias("ln"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey")
    # the two narrow tables meet first, so that the wide rows pass no shuffle for customers
    placed = orders.join(cust, F.col("o_custkey") == cust.c_custkey).select("o_orderkey", "c_nationkey")
    j = (
        li.join(supp, li.l_suppkey == supp.s_suppkey)
        .join(part, li.l_partkey == part.p_partkey)
        .drop("l_suppkey", "s_suppkey", "l_partkey")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    q, p, d, ln = F.col("q"), F.col("p"), F.col("d"), F.col("ln")
    return j.select(
        F.lit(1).cast("int").alias(S.RETAILER),
        (F.col("s_nationkey") % 3).cast("int").alias(S.VENDOR),
        S.PERIOD,
        (F.col("p_partkey") % 4).cast("int").alias(S.ITEM),
        (F.col("c_nationkey") % 4).cast("int").alias(S.STORE),
        S.OSA_TYPE,
        q.alias("total_units"),
        p.alias("total_sales"),
        (q * d + F.lit(0.0)).alias("lost_units"),
        (p * d + F.lit(0.0)).alias("lost_sales"),
        F.when(ln % 3 == 0, F.lit(0.0)).otherwise(q * 2).alias("retail_on_hand"),
        (q + q * d).alias("rs_demand"),
        F.when(F.col("returned"), F.lit(0.0)).otherwise(q + ln).alias("rs_inventory"),
        (ln * 1.5).cast("double").alias("osa_duration"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail calendar: one row per day, LY day = same weekday 52 weeks back.

    ``week_ended`` is the Saturday closing the day's Sunday-to-Saturday week.
    """
    span = table(spark, sf_dir, "lineitem").agg(
        F.year(F.min("l_shipdate")).alias("y0"), F.year(F.max("l_shipdate")).alias("y1")
    )
    days = span.select(
        F.explode(
            F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), F.make_date(F.col("y1") + 1, F.lit(12), F.lit(31)))
        ).alias("d")
    )
    d = F.col("d")
    return days.select(
        _period_key(d).alias(S.PERIOD),
        _period_key(F.date_sub(d, 364)).alias(S.LY_PERIOD),
        F.date_add(d, 7 - F.dayofweek(d)).alias(S.WEEK_ENDED),
        F.month(d).cast("int").alias("month"),
        F.year(d).cast("int").alias("year"),
        (F.year(d) * 100 + F.weekofyear(d)).cast("int").alias("year_week"),
    )


def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.groupBy((F.col("p_partkey") % 4).cast("int").alias(S.ITEM)).agg(
        F.count("*").cast("long").alias("part_count"), F.min("p_brand").alias("first_brand")
    )


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return cust.groupBy((F.col("c_nationkey") % 4).cast("int").alias(S.STORE)).agg(
        F.count("*").cast("long").alias("customer_count"), F.min("c_mktsegment").alias("first_segment")
    )


def dim_osa_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (
        li.select(
            F.when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("int").alias(S.OSA_TYPE),
            F.col("l_linestatus").alias("osa_class"),
        )
        .distinct()
    )


# DuckDB text of the same stand-ins, for the oracle queries.
FACT_SQL = """
SELECT CAST(1 AS INTEGER) AS retailer_key,
       CAST(s_nationkey % 3 AS INTEGER) AS vendor_key,
       CAST(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) AS INTEGER) AS period_key,
       CAST(p_partkey % 4 AS INTEGER) AS item_key,
       CAST(c_nationkey % 4 AS INTEGER) AS store_key,
       CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS INTEGER) AS osa_type_key,
       l_quantity AS total_units,
       l_extendedprice AS total_sales,
       l_quantity * l_discount + 0.0 AS lost_units,
       l_extendedprice * l_discount + 0.0 AS lost_sales,
       CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE l_quantity * 2 END AS retail_on_hand,
       l_quantity + l_quantity * l_discount AS rs_demand,
       CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity + l_linenumber END AS rs_inventory,
       CAST(l_linenumber * 1.5 AS DOUBLE) AS osa_duration
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN part ON l_partkey = p_partkey
"""

CALENDAR_SQL = """
SELECT CAST(year(d)*10000 + month(d)*100 + day(d) AS INTEGER) AS period_key,
       CAST(year(d - 364)*10000 + month(d - 364)*100 + day(d - 364) AS INTEGER) AS ly_period_key,
       CAST(d + CAST(6 - dayofweek(d) AS INTEGER) AS DATE) AS week_ended,
       CAST(month(d) AS INTEGER) AS month,
       CAST(year(d) AS INTEGER) AS year,
       CAST(year(d)*100 + weekofyear(d) AS INTEGER) AS year_week
FROM (
  SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1 + 1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT year(min(l_shipdate)) AS y0, year(max(l_shipdate)) AS y1 FROM lineitem)
)
"""

DIM_ITEM_SQL = (
    "SELECT CAST(p_partkey % 4 AS INTEGER) AS item_key, count(*) AS part_count, min(p_brand) AS first_brand "
    "FROM part GROUP BY 1"
)
DIM_STORE_SQL = (
    "SELECT CAST(c_nationkey % 4 AS INTEGER) AS store_key, count(*) AS customer_count, "
    "min(c_mktsegment) AS first_segment FROM customer GROUP BY 1"
)
DIM_OSA_CLASS_SQL = (
    "SELECT DISTINCT CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS INTEGER) AS osa_type_key, "
    "l_linestatus AS osa_class FROM lineitem"
)
