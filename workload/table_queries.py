"""Dimensions, reporting views, configuration and copies over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronoweave.functions import calendar as cal
from chronoweave.functions.text import COMMANDS, command_flags, string_spaces
from chronoweave.model import VALUES
from chronoweave.operators.copies import (
    copy_files,
    copy_imports,
    copy_series,
    duplicate_activities,
    listed,
)
from chronoweave.plans.config import (
    due,
    resolve_config,
    select_imports,
    with_parameters,
    with_run_columns,
)
from chronoweave.sources.generators import date_dimension, interval_dimension
from chronoweave.sources.views import (
    fact_day_view,
    fact_intraday_view,
    job_history_view,
    labelled_values,
)
from workload.inputs import (
    FORECASTS,
    INTRADAY_FACTS,
    ORDER_FACTS,
    SUPPLIER_ACTIVITY,
    SUPPLIER_FACTS,
    calendar_sql,
    event_source,
    forecasts,
    intraday_facts,
    order_facts,
    rounded,
    shown,
    supplier_activity,
    supplier_facts,
    table,
)

D = dt.date
RUN_DATE = D(2024, 3, 15)

CALENDAR_NAMES = (
    "year", "month", "day_month", "day_week", "week", "year52", "year_month", "year_month_char",
    "year_week", "year_week_short", "year_quarter", "month_days", "day_year", "weeks_2000",
)


def q_date_dimension(spark, sf):
    """Orders per day with every calendar attribute of the day."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return counts.join(_days_of(spark, counts), "date").select("date", "orders", *CALENDAR_NAMES)


def _days_of(spark, rows):
    """The date dimension from the first to the last day of rows."""
    return date_dimension(spark, *rows.agg(F.min("date"), F.max("date")).first())


SQL_DATE_DIMENSION = f"""SELECT date, orders, {calendar_sql('date')} FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1) o"""


def q_interval_dimension(spark, sf):
    """Events per quarter hour with the interval's attributes."""
    counts = event_source(spark, sf).groupBy("interval_id").agg(F.count(F.lit(1)).alias("events"))
    return counts.join(interval_dimension(spark), "interval_id")


SQL_INTERVAL_DIMENSION = """WITH e AS (
  SELECT CAST(hour(ts) * 4 + minute(ts) // 15 AS SMALLINT) AS interval_id, count(*) AS events FROM events GROUP BY 1),
p AS (SELECT interval_id, events, CAST(interval_id // 4 AS INTEGER) AS h, CAST((interval_id % 4) * 15 AS INTEGER) AS m,
        TIMESTAMP '1899-12-30 00:00:00' + to_minutes(CAST(interval_id * 15 AS INTEGER)) AS ts0 FROM e)
SELECT interval_id, events, strftime(ts0, '%H:%M') AS time_start, strftime(ts0, '%H:%M') AS time_end,
  ts0 AS time_start_datetime, ts0 + INTERVAL 14 MINUTE + INTERVAL 59 SECOND AS time_end_datetime,
  strftime(ts0, '%H') AS time_hour, CAST(h AS SMALLINT) AS time_hour_int,
  CASE m WHEN 0 THEN '00-29' WHEN 30 THEN '30-59' END AS time_halfhour,
  strftime(ts0, '%M') AS time_minute, CAST(m AS SMALLINT) AS time_minute_int,
  h || ':' || strftime(ts0, '%M') || ':00' AS time_start_sec,
  h || ':' || strftime(ts0 + INTERVAL 14 MINUTE, '%M') || ':59' AS time_end_sec,
  m IN (0, 30) AS period_30, m = 0 AS period_60,
  strftime(ts0 + INTERVAL 15 MINUTE, '%H:%M') AS time_end_exclusive
FROM p"""

_VIEW_COLUMNS = (
    "date_view", "activity_id", "forecast_id", "value1", "value2", "activity_name", "forecast_name",
    "activity_set", "domain", "region", "YYYY", "YYYYMM", "YYYYWww", "week", "month", "day_week",
    "site_id", "slicer1",
)


def _view_shown(view, *more):
    rows = view.withColumns({v: F.round(v, 4) for v in ("value1", "value2")})
    return rows.select(*_VIEW_COLUMNS, *more)


_VIEW_SQL = """SELECT f.date AS date_view, f.activity_id, f.forecast_id, round(value1, 4) AS value1,
  round(value2, 4) AS value2, activity_name, forecast_name, activity_set, domain, region,
  CAST(year(f.date) AS INTEGER) AS "YYYY", strftime(f.date, '%Y%m') AS "YYYYMM",
  isoyear(f.date) || 'W' || lpad(CAST(weekofyear(f.date) AS VARCHAR), 2, '0') AS "YYYYWww",
  CAST(weekofyear(f.date) AS INTEGER) AS week, CAST(month(f.date) AS INTEGER) AS month,
  CAST(isodow(f.date) AS INTEGER) AS day_week, site_id, slicer1"""


def q_fact_day_view(spark, sf):
    return _view_shown(
        fact_day_view(supplier_facts(spark, sf), supplier_activity(spark, sf), forecasts(spark, sf))
    )


SQL_FACT_DAY_VIEW = f"""WITH {SUPPLIER_FACTS}, {SUPPLIER_ACTIVITY}, {FORECASTS}
{_VIEW_SQL} FROM supplier_facts f JOIN supplier_activity a ON f.activity_id = a.activity_id
JOIN forecasts c ON f.forecast_id = c.forecast_id"""


def q_fact_intraday_view(spark, sf):
    facts = intraday_facts(spark, sf)
    return _view_shown(
        fact_intraday_view(
            facts,
            supplier_activity(spark, sf),
            forecasts(spark, sf),
            interval_dimension(spark),
            _days_of(spark, facts),
        ),
        "time_start",
    )


SQL_FACT_INTRADAY_VIEW = f"""WITH {INTRADAY_FACTS}, {SUPPLIER_ACTIVITY}, {FORECASTS}
{_VIEW_SQL}, lpad(CAST(interval_id // 4 AS VARCHAR), 2, '0') || ':' || lpad(CAST((interval_id % 4) * 15 AS VARCHAR), 2, '0') AS time_start
FROM intraday_facts f JOIN supplier_activity a ON f.activity_id = a.activity_id
JOIN forecasts c ON f.forecast_id = c.forecast_id"""


def q_labelled_values(spark, sf):
    """Supplier facts in long form; regions name different values."""
    named = {v: (F.concat(F.lit(f"{v} of "), "r_name") if v in ("value1", "value3") else F.lit(None).cast("string")) for v in VALUES}
    named["value2"] = F.when(F.col("r_regionkey") < 2, F.lit("price"))
    template = table(spark, sf, "region").select(
        (F.col("r_regionkey") + 1).cast("int").alias("template_id"),
        *[c.alias(v) for v, c in named.items()],
        *[F.concat(F.lit("in "), "r_name").alias(f"{v}_description") for v in VALUES],
    )
    rows = labelled_values(supplier_facts(spark, sf), supplier_activity(spark, sf), template)
    return rows.withColumn("value", F.round("value", 4))


SQL_LABELLED_VALUES = f"""WITH {SUPPLIER_FACTS}, {SUPPLIER_ACTIVITY},
f AS (SELECT f.*, template_id, domain FROM supplier_facts f JOIN supplier_activity a ON f.activity_id = a.activity_id)
SELECT date, site_id, activity_id, forecast_id, 'value1 of ' || domain AS value_name, 'in ' || domain AS value_description,
       round(value1, 4) AS value FROM f
UNION ALL SELECT date, site_id, activity_id, forecast_id, 'value3 of ' || domain, 'in ' || domain, round(value3, 4) FROM f
UNION ALL SELECT date, site_id, activity_id, forecast_id, 'price', 'in ' || domain, round(value2, 4) FROM f WHERE template_id <= 2"""


def q_job_history_view(spark, sf):
    """Orders as runs of their customers' jobs; the duration is the order key as hhmmss."""
    key = F.col("o_orderkey")
    history = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("job_id"),
        (key % 4).cast("int").alias("step_id"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("run_date"),
        ((key % 24) * 10000 + (key % 60) * 100 + key % 59).cast("int").alias("run_time"),
        ((key % 130) * 10000 + (key % 60) * 100 + key % 60).cast("int").alias("run_duration"),
        (key % 6).cast("int").alias("run_status"),
        F.col("o_orderpriority").alias("message"),
    )
    customers = table(spark, sf, "customer")
    jobs = customers.select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"))
    steps = customers.select(
        F.col("c_custkey").alias("job_id"),
        (F.col("c_custkey") % 4).cast("int").alias("step_id"),
        F.col("c_mktsegment").alias("step_name"),
    )
    view = job_history_view(jobs, history, steps, now=dt.datetime(2002, 1, 1))
    return view.withColumn("RunDateAndTime", F.col("RunDateAndTime").cast("string"))


SQL_JOB_HISTORY_VIEW = """WITH h AS (
  SELECT o_custkey AS job_id, CAST(o_orderkey % 4 AS INTEGER) AS step_id, CAST(o_orderdate AS DATE) AS d,
    CAST(o_orderkey % 24 AS INTEGER) AS th, CAST(o_orderkey % 60 AS INTEGER) AS tm, CAST(o_orderkey % 59 AS INTEGER) AS tsec,
    CAST(o_orderkey % 130 AS INTEGER) AS dh, CAST(o_orderkey % 60 AS INTEGER) AS dm,
    o_orderkey % 6 AS st, o_orderpriority AS message FROM orders),
x AS (SELECT h.*, c.c_name, s.c_mktsegment AS step_name, dh * 3600 + dm * 60 + dm AS secs,
    CAST(d AS TIMESTAMP) + to_seconds(th * 3600 + tm * 60 + tsec) AS started
  FROM h JOIN customer c ON h.job_id = c.c_custkey
  LEFT JOIN customer s ON h.job_id = s.c_custkey AND h.step_id = s.c_custkey % 4)
SELECT c_name AS "JobName", step_id,
  'step ' || lpad(CAST(step_id AS VARCHAR), 3, '0') || '. ' || coalesce(step_name, 'Job Status') AS "StepName",
  CAST(started AS DATE) AS "RunDate", strftime(started, '%Y-%m-%d %H:%M:%S') AS "RunDateAndTime",
  printf('%02d', dh) || ':' || lpad(CAST(dm AS VARCHAR), 2, '0') || ':' || lpad(CAST(dm AS VARCHAR), 2, '0') AS duration_time,
  CAST(secs AS INTEGER) AS duration_sec,
  CASE st WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Retry' WHEN 3 THEN 'Canceled' WHEN 4 THEN 'In Progress' END AS "RunStatus",
  secs || ' sec duration. ' || message AS message,
  CAST(date_diff('second', started, TIMESTAMP '2002-01-01 00:00:00') AS BIGINT) AS sec_ago, 1 AS site_id
FROM x"""


# --- configuration tables derived from customers (imports) and nations (procedures) ---


def _stamp(when: dt.datetime):
    """A time stamp of the session's time zone."""
    return F.lit(str(when)).cast("timestamp")


def _when(test: str, then: str, otherwise=None):
    return F.when(F.expr(test), F.lit(then)).otherwise(F.lit(otherwise))


def procedures(spark, sf):
    nation = table(spark, sf, "nation")
    return nation.select(
        (F.col("n_nationkey") + 1).cast("int").alias("procedure_id"),
        F.concat(F.lit(" "), "n_name").alias("procedure_name"),
        _when("n_nationkey % 3 = 0", "import", "ytd ").alias("procedure_code"),
        F.lit("SP").alias("app"),
        _when("n_nationkey % 2 = 0", "TEST", "LIVE").alias("status"),
        _when("n_regionkey = 1", "orders", " ").alias("source"),
        _when("n_regionkey = 2", " value2 ", None).alias("fields_source"),
        _when("n_regionkey = 2", "value2", "").alias("fields_target"),
        _when("n_nationkey % 4 < 2", " value1 > 0 ", "").alias("filter"),
        F.lit(None).cast("string").alias("group_by"),
        _when("n_nationkey = 3", "day_week = 1", None).alias("schedule"),
        _when("n_nationkey % 5 = 0", "30", " ").alias("days_back"),
        _when("n_nationkey % 5 = 1", "7", "x").alias("days_forward"),
        F.when(F.expr("n_nationkey % 4 = 1"), _stamp(dt.datetime(2020, 1, 1))).alias("date_import_from"),
        F.lit(None).cast("timestamp").alias("date_import_until"),
        _when("n_regionkey = 0", " 7 ", None).alias("p1"),
        *[F.lit(None).cast("string").alias(f"p{i}") for i in range(2, 6)],
        _when("n_nationkey % 2 = 1", " -NODELTA ", None).alias("commands"),
        F.lit("v1 ").alias("version"),
        (F.col("n_nationkey") % 4).cast("int").alias("sort_order"),
        (F.col("n_nationkey") != 24).alias("active"),
        F.lit("plan").alias("domain"),
        F.col("n_name").alias("category"),
        F.lit(None).cast("string").alias("description"),
        _stamp(dt.datetime(2023, 6, 1)).alias("date_updated"),
    )


def imports(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(
        (F.col("c_custkey") + 1).cast("int").alias("import_id"),
        F.col("c_name").alias("import_code"),
        (F.col("c_nationkey") + 1).cast("int").alias("procedure_id"),
        (F.col("c_custkey") % 60).cast("int").alias("activity_id"),
        (F.col("c_custkey") % 7).cast("int").alias("forecast_id"),
        _when("c_mktsegment = 'BUILDING'", " lineitem ", " ").alias("source"),
        _when("c_mktsegment = 'AUTOMOBILE'", "value3", "").alias("fields_source"),
        _when("c_mktsegment = 'AUTOMOBILE'", "value1", None).alias("fields_target"),
        _when("c_custkey % 3 = 0", " activity_id = 5", "  ").alias("filter"),
        _when("c_mktsegment = 'MACHINERY'", "l_shipdate", None).alias("group_by"),
        _when("c_custkey % 50 = 0", "month = 1", "").alias("schedule"),
        _when("c_custkey % 4 = 0", " 10", "").alias("days_back"),
        _when("c_custkey % 4 = 1", "3", None).alias("days_forward"),
        F.when(F.expr("c_custkey % 6 = 0"), _stamp(dt.datetime(2021, 5, 6, 7, 8, 9))).alias("date_import_from"),
        F.when(F.expr("c_custkey % 5 = 0"), _stamp(dt.datetime(2023, 12, 31))).alias("date_import_until"),
        _when("c_custkey % 2 = 0", "3", "").alias("p1"),
        *[F.lit(None).cast("string").alias(f"p{i}") for i in range(2, 6)],
        _when("c_custkey % 3 = 1", "-INTRADAY", "").alias("commands"),
        F.concat(F.lit(" "), "c_mktsegment").alias("version"),
        F.when(F.expr("c_custkey % 2 = 0"), (F.col("c_custkey") % 9).cast("int")).alias("sort_order"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.lit(None).cast("string").alias("domain"),
        F.col("c_mktsegment").alias("category"),
        F.when(F.expr("c_custkey % 2 = 1"), F.lit(1)).otherwise(F.lit(1)).alias("site_id"),
        F.when(F.expr("c_custkey % 2 = 0"), _stamp(dt.datetime(2024, 1, 2))).alias("date_updated"),
        F.lit("old").alias("import_guid"),
    )


CONFIG_SQL = f"""{SUPPLIER_ACTIVITY}, {FORECASTS},
p AS (SELECT n_nationkey AS k, CAST(n_nationkey + 1 AS INTEGER) AS procedure_id, n_name AS procedure_name,
  CASE WHEN n_nationkey % 3 = 0 THEN 'import' ELSE 'ytd' END AS procedure_code, n_regionkey AS r, n_nationkey <> 24 AS active
  FROM nation),
i AS (SELECT c_custkey AS k, CAST(c_custkey + 1 AS INTEGER) AS import_id, c_nationkey + 1 AS procedure_id,
  CAST(c_custkey % 60 AS INTEGER) AS activity_id, CAST(c_custkey % 7 AS INTEGER) AS forecast_id, c_mktsegment AS seg,
  c_acctbal > 0 AS active FROM customer),
resolved AS (
SELECT i.import_id, p.procedure_name, p.procedure_code, p.procedure_id,
  trim(CASE WHEN p.k % 2 = 1 THEN '-NODELTA' ELSE '' END || ' ' || CASE WHEN i.k % 3 = 1 THEN '-INTRADAY' ELSE '' END) AS commands,
  i.activity_id, i.forecast_id,
  CASE WHEN i.k % 2 = 0 THEN '3' WHEN r = 0 THEN '7' ELSE '' END AS p1,
  CASE WHEN i.k % 50 = 0 THEN 'month = 1' WHEN p.k = 3 THEN 'day_week = 1' ELSE '' END AS schedule,
  CASE WHEN seg = 'BUILDING' THEN 'lineitem' WHEN r = 1 THEN 'orders' ELSE '' END AS source,
  CASE WHEN seg = 'MACHINERY' THEN 'l_shipdate' ELSE '' END AS group_by,
  CASE WHEN seg = 'AUTOMOBILE' THEN 'value3' WHEN r = 2 THEN 'value2' ELSE 'value1' END AS fields_source,
  CASE WHEN seg = 'AUTOMOBILE' THEN 'value1' WHEN r = 2 THEN 'value2' ELSE '' END AS fields_target,
  CAST(1000 * (p.k % 4) + 100 * a.sort_order + CASE WHEN i.k % 2 = 0 THEN i.k % 9 ELSE 1 END AS INTEGER) AS sort_order,
  CASE WHEN i.k % 6 = 0 THEN DATE '2021-05-06' WHEN i.k % 4 = 0 THEN DATE '2024-03-05'
       WHEN p.k % 4 = 1 THEN DATE '2020-01-01' WHEN p.k % 5 = 0 THEN DATE '2024-02-14' ELSE DATE '1900-01-01' END AS date_import_from,
  CASE WHEN i.k % 5 = 0 THEN DATE '2023-12-31' WHEN i.k % 4 = 1 THEN DATE '2024-03-18'
       WHEN p.k % 5 = 1 THEN DATE '2024-03-22' ELSE DATE '9999-01-01' END AS date_import_until,
  CASE WHEN p.k % 4 < 2 AND i.k % 3 = 0 THEN 'value1 > 0 AND (activity_id = 5)' WHEN p.k % 4 < 2 THEN 'value1 > 0'
       WHEN i.k % 3 = 0 THEN '(activity_id = 5)' ELSE '' END AS filter,
  a.activity_name, a.parent, a.channel, f.forecast_name,
  CASE WHEN i.active AND p.active AND a.active AND f.active THEN 1 ELSE 0 END AS active,
  'v1 ' || seg AS version, p.procedure_name AS procedure_category,
  CASE WHEN i.k % 2 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2023-06-01 00:00:00' END AS date_updated
FROM i JOIN p ON i.procedure_id = p.procedure_id JOIN supplier_activity a ON i.activity_id = a.activity_id
JOIN forecasts f ON i.forecast_id = f.forecast_id WHERE i.activity_id > 0 AND i.forecast_id > 0)"""

_RESOLVED = (
    "import_id", "procedure_name", "procedure_code", "procedure_id", "commands", "activity_id", "forecast_id",
    "p1", "schedule", "source", "group_by", "fields_source", "fields_target", "sort_order",
    "date_import_from", "date_import_until", "filter", "activity_name", "parent", "channel",
    "forecast_name", "active", "version", "procedure_category",
)


def resolved(spark, sf):
    return resolve_config(
        imports(spark, sf), procedures(spark, sf), supplier_activity(spark, sf), forecasts(spark, sf), RUN_DATE
    )


def q_resolve_config(spark, sf):
    return resolved(spark, sf).select(
        *_RESOLVED, F.date_format("date_updated", "yyyy-MM-dd").alias("date_updated")
    )


SQL_RESOLVE_CONFIG = f"""WITH {CONFIG_SQL}
SELECT {", ".join(_RESOLVED)}, strftime(date_updated, '%Y-%m-%d') AS date_updated FROM resolved"""


def q_select_imports(spark, sf):
    rows = select_imports(resolved(spark, sf), "import", site_id=1, procedure_name="NATION_%")
    return rows.select("import_id", "procedure_name", "sort_order", "active")


SQL_SELECT_IMPORTS = f"""WITH {CONFIG_SQL}
SELECT import_id, procedure_name, sort_order, active FROM resolved
WHERE active = 1 AND procedure_code = 'import' AND procedure_name LIKE 'NATION_%'"""


def q_json_param_merge(spark, sf):
    """Parameters passed for a run, one set per event type, laid over those of each event."""
    passed = F.when(
        F.col("event_type") == "click",
        F.lit('{"date_import_from":"2021-01-01","intraday_duration":"30","k":"9"}'),
    ).when(F.col("event_type") == "view", F.lit('{"source_import_id_field":"mark","date_import_until":"soon"}')).otherwise("{}")
    rows = table(spark, sf, "events").select(
        "event_id",
        "props",
        F.lit(D(2020, 1, 1)).alias("date_import_from"),
        F.lit(D(2020, 12, 31)).alias("date_import_until"),
        passed.alias("passed"),
    )
    return with_parameters(rows, F.col("passed"), "props", keep=("k",)).drop("props", "passed")


SQL_JSON_PARAM_MERGE = """
SELECT event_id, CASE WHEN event_type = 'click' THEN '9' ELSE json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_type = 'click' THEN DATE '2021-01-01' ELSE DATE '2020-01-01' END AS date_import_from,
  DATE '2020-12-31' AS date_import_until,
  CASE WHEN event_type = 'view' THEN 'mark' ELSE '' END AS source_import_id_field,
  CAST(CASE WHEN event_type = 'click' THEN 30 ELSE 15 END AS INTEGER) AS intraday_duration
FROM events"""

SCHEDULES = {
    "mondays": ("[day_week] = 1", "isodow(d) = 1"),
    "first_days": ("day_month <= 3 and month(run_ts) in (1, 7)", "day(d) <= 3 AND month(d) IN (1, 7)"),
    "long_months": ("run_date > '1996-06-30' and month_days = 31", "d > DATE '1996-06-30' AND day(last_day(d)) = 31"),
    "unknown": ("nullif(week, week) = 1", "false"),
}


def q_schedule_test(spark, sf):
    """Whether each schedule would have run on the day of each order."""
    days = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderdate").alias("run_ts")
    )
    return with_run_columns(days).select(
        "o_orderkey", *[due(text).alias(name) for name, (text, _) in SCHEDULES.items()]
    )


SQL_SCHEDULE_TEST = (
    "SELECT o_orderkey, "
    + ", ".join(f"{test} AS {name}" for name, (_, test) in SCHEDULES.items())
    + " FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o"
)

_FLAG_TEXT = {
    "BUILDING": "-print  -NODELTA\\t-LOG_QUERY",
    "AUTOMOBILE": "-NO_SCHEDULE -SUMFIELDS",
    "MACHINERY": "-NOINTRADAY -DELETE_TAIL",
}
_FLAGS_SHOWN = ("PRINT", "NODELTA", "NOSCHEDULE", "SUMFIELDS", "INTRADAY", "NOINTRADAY", "DELETE_TAIL", "DELETE_HEAD")


def q_command_flags(spark, sf):
    text = F.lit(None).cast("string")
    for segment, commands in _FLAG_TEXT.items():
        text = F.when(F.col("c_mktsegment") == segment, F.lit(commands.replace("\\t", "\t"))).otherwise(text)
    flags = command_flags(text)
    return table(spark, sf, "customer").select(
        "c_custkey", *[flags[f].alias(f.lower()) for f in COMMANDS if f in _FLAGS_SHOWN]
    )


def _flag_sql() -> str:
    def test(flag: str) -> str:
        holders = [s for s, t in _FLAG_TEXT.items() if f"-{flag}" in t.replace("\\t", " ").upper().split()]
        return f"c_mktsegment IN ({', '.join(repr(h) for h in holders)})" if holders else "false"

    return "SELECT c_custkey, " + ", ".join(f"{test(f)} AS {f.lower()}" for f in _FLAGS_SHOWN) + " FROM customer"


# --- copies -----------------------------------------------------------------------


def _all_ids(df, column):
    return df.select(column)


def q_copy_imports(spark, sf):
    """Every import copied to forecast 9 under new ids."""
    rows = imports(spark, sf)
    first = 5_000_000
    copies = copy_imports(rows, _all_ids(rows, "import_id"), 9, first)
    return copies.select("import_id", "old_import_id", "forecast_id", "activity_id", "procedure_id", "commands", "version")


SQL_COPY_IMPORTS = """
SELECT CAST(4999999 + row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS import_id,
  CAST(c_custkey + 1 AS INTEGER) AS old_import_id, 9 AS forecast_id, CAST(c_custkey % 60 AS INTEGER) AS activity_id,
  CAST(c_nationkey + 1 AS INTEGER) AS procedure_id, CASE WHEN c_custkey % 3 = 1 THEN '-INTRADAY' ELSE '' END AS commands,
  ' ' || c_mktsegment AS version
FROM customer"""


def q_copy_series(spark, sf):
    """The order series copied to forecast 7 with their imports 101..105."""
    facts = order_facts(spark, sf)
    configured = facts.select("import_id", "activity_id").distinct().withColumn("forecast_id", F.lit(1))
    copies = copy_imports(configured, "101,102,103,104,105", 7, 2001)
    return shown(copy_series(facts, copies, 7), "value1", "value2")


SQL_COPY_SERIES = f"""WITH {ORDER_FACTS}
SELECT date, activity_id, 7 AS forecast_id, site_id, import_id + 1900 AS import_id, {rounded('value1', 'value2')}
FROM order_facts"""


def q_copy_files(spark, sf):
    """File settings of two sites (parts by brand and size); one site's files are copied."""
    files = table(spark, sf, "part").select(
        (F.col("p_partkey") + 1).cast("int").alias("file_id"),
        F.col("p_name").alias("file_name"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("rows_skip"),
        (F.col("p_size") % 2 + 1).cast("int").alias("site_id"),
        F.lit(3).alias("forecast_id"),
        F.lit("s0").alias("session"),
    )
    return copy_files(files, _all_ids(files, "file_id"), 2, 9_000_000, 4, "2025", "s1")


SQL_COPY_FILES = """
SELECT CAST(8999999 + row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS file_id, p_name AS file_name,
  p_type || '2025' AS category, p_size AS rows_skip, 2 AS site_id, 4 AS forecast_id, 's1' AS session
FROM part WHERE p_size % 2 = 1"""


def _duplicated(spark, sf):
    activity = supplier_activity(spark, sf)
    return duplicate_activities(
        activity, imports(spark, sf), _all_ids(activity, "activity_id"), 7_000_001, 6_000_001,
        "Supplier#0", "Copy ", "NEWDOMAIN",
    )


def q_duplicate_activities(spark, sf):
    return _duplicated(spark, sf)[0].select(
        "activity_id", "activity_name", "domain", "activity_set", "active"
    )


SQL_DUPLICATE_ACTIVITIES = f"""WITH {SUPPLIER_ACTIVITY}
SELECT CAST(7000000 + row_number() OVER (ORDER BY activity_id) AS INTEGER) AS activity_id,
  replace(activity_name, 'Supplier#0', 'Copy ') AS activity_name, 'NEWDOMAIN' AS domain, activity_set, active
FROM supplier_activity"""


def q_duplicate_activity_imports(spark, sf):
    return _duplicated(spark, sf)[1].select("import_id", "import_code", "activity_id", "forecast_id")


SQL_DUPLICATE_ACTIVITY_IMPORTS = f"""WITH {SUPPLIER_ACTIVITY},
new_ids AS (SELECT activity_id, 7000000 + row_number() OVER (ORDER BY activity_id) AS new_id FROM supplier_activity)
SELECT CAST(6000000 + row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS import_id, c_name AS import_code,
  CAST(new_id AS INTEGER) AS activity_id, CAST(c_custkey % 7 AS INTEGER) AS forecast_id
FROM customer JOIN new_ids ON c_custkey % 60 = activity_id"""


def q_id_list_filter(spark, sf):
    """Customers of the nations named in comma-separated id texts, one text per nation."""
    lists = table(spark, sf, "nation").where("n_regionkey <> 1").select(
        F.concat_ws(",", (F.col("n_nationkey") + 1000).cast("string"), F.col("n_nationkey").cast("string")).alias("ids")
    )
    ids = lists.select(F.explode(F.split("ids", ",")).alias("id"))
    return listed(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.round("c_acctbal", 4).alias("c_acctbal")),
        "c_nationkey", ids,
    )


SQL_ID_LIST_FILTER = """
SELECT c_custkey, c_nationkey, round(c_acctbal, 4) AS c_acctbal FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)"""

_BOUNDS = {
    "first_day_current_year": "date_trunc('year', d)",
    "first_day_next_year": "date_trunc('year', d) + INTERVAL 1 YEAR",
    "first_day_previous_year": "date_trunc('year', d) - INTERVAL 1 YEAR",
    "last_day_current_year": "date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY",
    "last_day_next_year": "date_trunc('year', d) + INTERVAL 2 YEAR - INTERVAL 1 DAY",
    "last_day_previous_year": "date_trunc('year', d) - INTERVAL 1 DAY",
    "first_day_current_year_week": "date_trunc('week', make_date(year(d), 1, 4))",
}


def q_year_bounds(spark, sf):
    """All year bounds of every order's date."""
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", *[getattr(cal, name)(d).alias(name) for name in _BOUNDS]
    )


SQL_YEAR_BOUNDS = (
    "SELECT o_orderkey, "
    + ", ".join(f"CAST({sql} AS DATE) AS {name}" for name, sql in _BOUNDS.items())
    + " FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o"
)


def q_string_spaces(spark, sf):
    """Every document's whole text with its white space collapsed."""
    text = string_spaces(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.length(text).cast("bigint").alias("n"), F.md5(text.cast("binary")).alias("digest")
    )


SQL_STRING_SPACES = r"""
SELECT doc_id, CAST(length(t) AS BIGINT) AS n, md5(t) AS digest
FROM (SELECT doc_id, regexp_replace(text, '[ \t\r\n]+', ' ', 'g') AS t FROM documents) d"""

QUERIES = {
    "date_dimension": q_date_dimension,
    "interval_dimension": q_interval_dimension,
    "fact_day_view": q_fact_day_view,
    "fact_intraday_view": q_fact_intraday_view,
    "labelled_values": q_labelled_values,
    "job_history_view": q_job_history_view,
    "resolve_config": q_resolve_config,
    "select_imports": q_select_imports,
    "json_param_merge": q_json_param_merge,
    "schedule_test": q_schedule_test,
    "command_flags": q_command_flags,
    "copy_imports": q_copy_imports,
    "copy_series": q_copy_series,
    "copy_files": q_copy_files,
    "duplicate_activities": q_duplicate_activities,
    "duplicate_activity_imports": q_duplicate_activity_imports,
    "id_list_filter": q_id_list_filter,
    "year_bounds": q_year_bounds,
    "string_spaces": q_string_spaces,
}
ORACLE = {
    "date_dimension": SQL_DATE_DIMENSION,
    "interval_dimension": SQL_INTERVAL_DIMENSION,
    "fact_day_view": SQL_FACT_DAY_VIEW,
    "fact_intraday_view": SQL_FACT_INTRADAY_VIEW,
    "labelled_values": SQL_LABELLED_VALUES,
    "job_history_view": SQL_JOB_HISTORY_VIEW,
    "resolve_config": SQL_RESOLVE_CONFIG,
    "select_imports": SQL_SELECT_IMPORTS,
    "json_param_merge": SQL_JSON_PARAM_MERGE,
    "schedule_test": SQL_SCHEDULE_TEST,
    "command_flags": _flag_sql(),
    "copy_imports": SQL_COPY_IMPORTS,
    "copy_series": SQL_COPY_SERIES,
    "copy_files": SQL_COPY_FILES,
    "duplicate_activities": SQL_DUPLICATE_ACTIVITIES,
    "duplicate_activity_imports": SQL_DUPLICATE_ACTIVITY_IMPORTS,
    "id_list_filter": SQL_ID_LIST_FILTER,
    "year_bounds": SQL_YEAR_BOUNDS,
    "string_spaces": SQL_STRING_SPACES,
}
