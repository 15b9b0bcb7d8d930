"""Whole batches through the runner and a fact store, configured by tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronoweave.model import DIM_ACTIVITY, DIM_FORECAST, IMPORT, IMPORT_PROCEDURE, local_table
from chronoweave.plans.runner import Runner, Tables
from chronoweave.plans.store import FactStore
from workload.import_queries import SQL_IMPORT_DAY
from workload.inputs import ORDER_FACTS, scratch, shown, table
from workload.series_queries import SQL_YTD_OF_IMPORT

#: The time of the runs: `getdate()` in schedules.
NOW = dt.datetime(2024, 3, 15, 12, 0, tzinfo=dt.timezone.utc)


def _tables(spark, sf, *imports: dict) -> Tables:
    """Orders per priority as series and their year-to-date, the latter configured first but sorted last."""
    shared = {"active": True, "site_id": 1, "app": "SP", "status": "TEST"}
    procedures = [
        {"procedure_id": 2, "procedure_name": "YTD", "procedure_code": "ytd", "p1": "1", "p2": "month", "sort_order": 2, **shared},
        {"procedure_id": 1, "procedure_name": "ORDERS", "procedure_code": "import", "source": "[orders]", "group_by": "o_orderdate",
         "fields_source": "count(*), sum(o_totalprice)", "fields_target": "[value1],[value2]", "sort_order": 1, **shared},
    ]
    chosen = [
        {"import_id": 100 + n, "procedure_id": 1, "activity_id": n, "forecast_id": 1, "filter": f"o_orderpriority like '{n}-%'"} for n in range(1, 6)
    ] + [{"import_id": 700 + n, "procedure_id": 2, "activity_id": n, "forecast_id": 25} for n in range(1, 6)]
    own = {"active": True, "site_id": 1}
    return Tables(
        imports=local_table(spark, [{**own, **i} for i in [*chosen, *imports]], IMPORT),
        procedures=local_table(spark, procedures, IMPORT_PROCEDURE),
        activity=local_table(spark, [{"activity_id": n, "activity_name": f"priority {n}", **own} for n in range(1, 8)], DIM_ACTIVITY),
        forecast=local_table(spark, [{"forecast_id": n, "forecast_name": f"forecast {n}", **own} for n in (1, 25)], DIM_FORECAST),
        sources={"orders": table(spark, sf, "orders")},
    )


def q_runner_batch_facts(spark, sf):
    """The facts of a store after a batch that was run twice: the second run replaces what the first wrote."""
    store = FactStore(spark, scratch(spark))
    runner = Runner(spark, _tables(spark, sf), store, when=NOW)
    runner.run_all()
    runner.run("import", activity_id=2)
    return shown(store.read(), "value1", "value2")


SQL_RUNNER_BATCH_FACTS = f"SELECT * FROM ({SQL_IMPORT_DAY}) UNION ALL BY NAME SELECT * FROM ({SQL_YTD_OF_IMPORT})"


def q_runner_batch_log(spark, sf):
    """The log of a batch in which one import has a filter that does not resolve, and one is not due."""
    wrong = {"import_id": 106, "procedure_id": 1, "activity_id": 6, "forecast_id": 1, "filter": "no_such_column = 1"}
    later = {"import_id": 107, "procedure_id": 1, "activity_id": 7, "forecast_id": 1, "schedule": "to_date(getdate()) = '2024-03-16'"}
    folder = scratch(spark)
    runner = Runner(spark, _tables(spark, sf, wrong, later), FactStore(spark, f"{folder}/day"), log_path=f"{folder}/log", when=NOW)
    runner.run_all(commands="-LOG_ROWCOUNT -LOG_WARNING")
    log = spark.read.parquet(f"{folder}/log").where("category = 'SERIES RUN'")
    return log.select(
        "step", "object", "object_id", "result", "value",
        F.get_json_object("data", "$.Line").alias("condition"), F.get_json_object("data", "$.Inserted").cast("bigint").alias("inserted"),
    )


SQL_RUNNER_BATCH_LOG = f"""WITH {ORDER_FACTS},
days AS (SELECT activity_id AS a, count(*) AS n FROM order_facts GROUP BY 1),
months AS (SELECT activity_id AS a, count(DISTINCT date_trunc('month', date)) AS n FROM order_facts GROUP BY 1),
logged(step, object, object_id, result, value, condition, inserted) AS (
  SELECT 'START', o, NULL, 'Succeeded', NULL, NULL, NULL FROM (VALUES ('import'), ('ytd')) t(o)
  UNION ALL SELECT 'INSERT DAY', 'import', 100 + a, 'Succeeded', n, NULL, NULL FROM days
  UNION ALL SELECT 'DELETE DAY', 'import', 100 + a, 'Succeeded', 0, NULL, NULL FROM days
  UNION ALL SELECT 'INSERT DAY', 'ytd', 700 + a, 'Succeeded', n, NULL, NULL FROM months
  UNION ALL SELECT 'DELETE DAY', 'ytd', 700 + a, 'Succeeded', 0, NULL, NULL FROM months
  UNION ALL SELECT 'INSERT DAY', 'import', 106, 'Failed', NULL, 'UNRESOLVED_COLUMN.WITH_SUGGESTION', NULL
  UNION ALL SELECT 'SCHEDULE TEST', 'import', 107, 'Warning', NULL, NULL, NULL
  UNION ALL SELECT 'IMPORT SUMMARY', 'import', 106, 'Failed', 1, NULL, 0
  UNION ALL SELECT 'END', 'import', NULL, 'Failed', 1, NULL, sum(n) FROM days
  UNION ALL SELECT 'END', 'ytd', NULL, 'Succeeded', 0, NULL, sum(n) FROM months)
SELECT step, object, CAST(object_id AS INTEGER) AS object_id, result, CAST(value AS BIGINT) AS value, condition, CAST(inserted AS BIGINT) AS inserted FROM logged"""

QUERIES = {"runner_batch_facts": q_runner_batch_facts, "runner_batch_log": q_runner_batch_log}
ORACLE = {"runner_batch_facts": SQL_RUNNER_BATCH_FACTS, "runner_batch_log": SQL_RUNNER_BATCH_LOG}
