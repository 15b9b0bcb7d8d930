"""The driver tables as series: Spark inputs and the same inputs as SQL for the oracle."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.model import VALUES, as_fact_day, as_fact_intraday
from chronoweave.sources.generators import interval_of

KEYS = ["date", "activity_id", "forecast_id", "site_id", "import_id"]


# Declared, so that reading a table starts no job to infer its columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def shown(facts: DataFrame, *values: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows for comparison: keys and rounded values, no run-time columns."""
    return facts.select(*KEYS, *more, *[F.round(v, 4).alias(v) for v in values])


def order_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per day and priority (activity 1..5): number and total price, forecast 1."""
    orders = table(spark, sf, "orders")
    return as_fact_day(
        orders.groupBy(
            F.col("o_orderdate").cast("date").alias("date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("activity_id"),
        )
        .agg(F.count(F.lit(1)).cast("double").alias("value1"), F.sum("o_totalprice").alias("value2"))
        .withColumns({"forecast_id": F.lit(1), "site_id": F.lit(1), "import_id": F.col("activity_id") + 100})
    )


ORDER_FACTS = """order_facts AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS activity_id,
         1 AS forecast_id, 1 AS site_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 100 AS import_id,
         CAST(count(*) AS DOUBLE) AS value1, sum(o_totalprice) AS value2
  FROM orders GROUP BY ALL)"""


def supplier_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped per day and supplier (activity = key + 1): quantity, price, lines."""
    lines = table(spark, sf, "lineitem")
    return as_fact_day(
        lines.groupBy(
            F.col("l_shipdate").cast("date").alias("date"),
            (F.col("l_suppkey") + 1).cast("int").alias("activity_id"),
        )
        .agg(
            F.sum("l_quantity").alias("value1"),
            F.sum("l_extendedprice").alias("value2"),
            F.count(F.lit(1)).cast("double").alias("value3"),
        )
        .withColumns({"forecast_id": F.lit(1), "site_id": F.lit(1)})
    )


SUPPLIER_FACTS = """supplier_facts AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey + 1 AS INTEGER) AS activity_id,
         1 AS forecast_id, 1 AS site_id, CAST(NULL AS INTEGER) AS import_id,
         sum(l_quantity) AS value1, sum(l_extendedprice) AS value2, CAST(count(*) AS DOUBLE) AS value3
  FROM lineitem GROUP BY ALL)"""


def supplier_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as the activity dimension: nation is the set and region the domain."""
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("s_suppkey") + 1).cast("int").alias("activity_id"),
            F.col("s_name").alias("activity_name"),
            F.col("n_name").alias("activity_set"),
            F.col("r_name").alias("domain"),
            F.col("n_name").alias("region"),
            F.concat(F.lit("  "), (F.col("s_nationkey") + 1).cast("string")).alias("parent"),
            F.lit("supply").alias("category"),
            F.lit(None).cast("string").alias("resource"),
            F.lit("road ").alias("channel"),
            F.lit(None).cast("string").alias("segment"),
            F.substring("s_name", -1, 1).alias("slicer1"),
            F.lit(None).cast("string").alias("slicer2"),
            F.lit(None).cast("string").alias("slicer3"),
            (F.col("s_suppkey") % 3).cast("smallint").alias("sort_order"),
            (F.col("s_acctbal") > 0).alias("active"),
            (F.col("n_regionkey") + 1).cast("int").alias("template_id"),
            F.lit(1).alias("site_id"),
        )
    )


SUPPLIER_ACTIVITY = """supplier_activity AS (
  SELECT CAST(s_suppkey + 1 AS INTEGER) AS activity_id, s_name AS activity_name, n_name AS activity_set,
         r_name AS domain, n_name AS region, CAST(s_nationkey + 1 AS VARCHAR) AS parent,
         'supply' AS category, 'road' AS channel, right(s_name, 1) AS slicer1,
         CAST(s_suppkey % 3 AS INTEGER) AS sort_order, s_acctbal > 0 AS active, n_regionkey + 1 AS template_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """One forecast per region."""
    return table(spark, sf, "region").select(
        (F.col("r_regionkey") + 1).cast("int").alias("forecast_id"),
        F.col("r_name").alias("forecast_name"),
        (F.col("r_regionkey") < 4).alias("active"),
    )


FORECASTS = """forecasts AS (
  SELECT CAST(r_regionkey + 1 AS INTEGER) AS forecast_id, r_name AS forecast_name, r_regionkey < 4 AS active
  FROM region)"""

# Activity of each event type.
EVENT_ACTIVITY = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def event_activity():
    out = F.lit(None).cast("int")
    for name, number in EVENT_ACTIVITY.items():
        out = F.when(F.col("event_type") == name, number).otherwise(out)
    return out


EVENT_ACTIVITY_SQL = (
    "CASE event_type " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in EVENT_ACTIVITY.items()) + " END"
)


def event_source(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their date and 15-minute interval."""
    return table(spark, sf, "events").withColumns(
        {
            "date": F.col("ts").cast("date"),
            "interval_id": interval_of(F.col("ts")),
            "site_id": F.lit(1),
            "import_id": F.lit(None).cast("int"),
        }
    )


EVENT_SOURCE = f"""event_source AS (
  SELECT *, CAST(ts AS DATE) AS date, CAST(hour(ts) * 4 + minute(ts) // 15 AS SMALLINT) AS interval_id,
         {EVENT_ACTIVITY_SQL} AS activity_id
  FROM events)"""


def intraday_facts(spark: SparkSession, sf: str) -> DataFrame:
    return as_fact_intraday(
        event_source(spark, sf)
        .withColumn("activity_id", event_activity())
        .groupBy("date", "interval_id", "activity_id", "site_id")
        .agg(F.count(F.lit(1)).cast("double").alias("value1"), F.sum("value").alias("value2"))
        .withColumns({"forecast_id": F.lit(1), "duration_min": F.lit(15), "import_id": F.lit(1)})
    )


INTRADAY_FACTS = (
    EVENT_SOURCE
    + """, intraday_facts AS (
  SELECT date, interval_id, activity_id, 1 AS site_id, 1 AS forecast_id, 1 AS import_id,
         CAST(15 AS SMALLINT) AS duration_min, CAST(count(*) AS DOUBLE) AS value1, sum(value) AS value2
  FROM event_source GROUP BY date, interval_id, activity_id)"""
)


def calendar_sql(d: str, prefix: str = "") -> str:
    """The calendar attributes of a date expression, for the oracle."""
    parts = {
        "year": f"CAST(year({d}) AS INTEGER)",
        "month": f"CAST(month({d}) AS INTEGER)",
        "day_month": f"CAST(day({d}) AS INTEGER)",
        "day_week": f"CAST(isodow({d}) AS INTEGER)",
        "week": f"CAST(weekofyear({d}) AS INTEGER)",
        "year52": f"CAST(isoyear({d}) AS INTEGER)",
        "year_month": f"CAST(year({d}) * 100 + month({d}) AS INTEGER)",
        "year_month_char": f"strftime({d}, '%Y%m')",
        "year_week": f"CAST(isoyear({d}) * 100 + weekofyear({d}) AS INTEGER)",
        "year_week_short": f"isoyear({d}) || 'W' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0')",
        "year_quarter": f"CAST(year({d}) * 10 + quarter({d}) AS INTEGER)",
        "month_days": f"CAST(day(last_day({d})) AS INTEGER)",
        "day_year": f"CAST(dayofyear({d}) AS INTEGER)",
        "weeks_2000": f"CAST(floor(date_diff('day', DATE '2000-01-03', {d}) / 7.0) AS INTEGER)",
    }
    return ", ".join(f"{v} AS {prefix}{k}" for k, v in parts.items())


def rounded(*values: str) -> str:
    return ", ".join(f"round({v}, 4) AS {v}" for v in values)


ALL_VALUES = list(VALUES)


def scratch(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share."""
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared or tempfile.mkdtemp(prefix='workload-')}/{uuid.uuid4().hex}"
