"""Levels of imports: order, rings, and the facts of a run in sequence."""

import datetime as dt
import json

from pyspark.sql import functions as F

from chronoweave.model import Run
from chronoweave.plans.levels import levels
from test_plans import config, facts_of, make_runner, source

D = dt.date
SHARED = {"app": "SP", "status": "TEST"}


def test_writers_go_before_readers():
    imports = [
        ("alert", Run(1, 9, 8, filter="forecast_id = 5 and activity_id = 1", date_from=D(2024, 1, 1), date_until=D(2024, 2, 1))),
        ("ytd", Run(2, 1, 5, p1="1", p2="month")),
        ("import", Run(3, 1, 1, source="sales")),
        ("import", Run(4, 2, 1, source="sales")),
        ("ytd", Run(5, 2, 5, p1="1", p2="month", site_id=2)),
        ("parallel", Run(6, 1, 1, p1="1", p5="1", date_from=D(2025, 1, 1), date_until=D(2025, 12, 31))),
        ("import", Run(7, 1, 1, source="sales", date_from=D(2030, 1, 1))),
    ]
    # The parallel period writes, after the import, into the series that it reads, and the alert reads all forecasts.
    order, rings = levels(imports)
    assert rings == [] and order == [[2, 3, 4], [5, 6], [1], [0]]


def test_imports_that_write_the_same_keep_their_order():
    runs = [Run(n, 1, 1, source="s", date_from=D(2024, n, 1), date_until=D(2024, n + 1, 1)) for n in (1, 2, 3)]
    assert levels([("import", r) for r in runs])[0] == [[0], [1], [2]]
    assert levels([("import", r.with_window(D(2024, 1, 1), D(2024, 1, 31))) for r in runs[:1]] + [("import", runs[2])])[0] == [[0, 1]]
    wide = [("ytd", Run(1, 1, 5, p1="1", filter="domain = 'x'")), ("ytd", Run(2, 3, 5, p1="1"))]
    assert levels(wide)[0] == [[0], [1]]


def test_rings():
    ring = [("ytd", Run(1, 1, 5, p1="6")), ("ytd", Run(2, 1, 6, p1="5")), ("ytd", Run(3, 1, 7, p1="6")), ("ytd", Run(4, 1, 9, p1="8"))]
    order, rings = levels(ring)
    assert rings == [[0, 1]] and order == [[2, 3]]
    own = ("parallel", Run(1, 1, 5, p1="5", p5="1"))
    assert levels([own]) == ([[0]], [])
    assert levels([]) == ([], [])


def tables(spark, *more):
    procedures = [
        {"procedure_id": 1, "procedure_name": "SALES", "procedure_code": "import", "source": "sales", "group_by": "day", "sort_order": 1,
         "fields_source": "sum(v)", "fields_target": "value1", **SHARED},
        {"procedure_id": 2, "procedure_name": "YTD", "procedure_code": "ytd", "p2": "month", "sort_order": 2, **SHARED},
        {"procedure_id": 3, "procedure_name": "PAST", "procedure_code": "parallel", "sort_order": 3, **SHARED},
        {"procedure_id": 4, "procedure_name": "YTD 2", "procedure_code": "ytd", "p2": "month", "sort_order": 4, **SHARED},
        {"procedure_id": 5, "procedure_name": "BROKEN", "procedure_code": "unknown", "sort_order": 5, **SHARED},
    ]
    imports = [
        {"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "kind='a'"},
        {"import_id": 2, "procedure_id": 1, "activity_id": 2, "forecast_id": 1, "filter": "kind='b'"},
        {"import_id": 3, "procedure_id": 2, "activity_id": 1, "forecast_id": 4, "p1": "1"},
        {"import_id": 4, "procedure_id": 3, "activity_id": 1, "forecast_id": 6, "p1": "4", "p2": "m", "p5": "1"},
        {"import_id": 5, "procedure_id": 4, "activity_id": 2, "forecast_id": 4, "p1": "1"},
        *more,
    ]
    found = config(spark, imports, procedures, activities=(1, 2, 3), forecasts=(1, 4, 6, 8, 9))
    found.sources["sales"] = source(spark, [("2023-01-01", "a", 1.0), ("2023-02-01", "b", 2.0), ("2023-02-05", "a", 4.0)])
    return found


def test_levels_give_the_facts_of_a_sequence(spark, tmp_path):
    ring = [
        {"import_id": 8, "procedure_id": 2, "activity_id": 3, "forecast_id": 8, "p1": "9"},
        {"import_id": 9, "procedure_id": 4, "activity_id": 3, "forecast_id": 9, "p1": "8"},
    ]
    in_sequence = make_runner(spark, tmp_path / "a", tables(spark))
    in_sequence.run_all()
    by_level = make_runner(spark, tmp_path / "b", tables(spark, *ring))
    results = by_level.run_levels()
    assert facts_of(by_level.day) == facts_of(in_sequence.day) and len(facts_of(by_level.day)) == 8
    assert {n: r["Errors"] for n, r in results.items()} == {"SALES": 0, "YTD": 1, "PAST": 0, "YTD 2": 1, "BROKEN": 1}
    log = spark.read.parquet(str(tmp_path / "b" / "log"))
    found = [r["data"] for r in log.where("step = 'LEVEL'").orderBy("value").collect()]
    assert [json.loads(f) for f in found] == [{"import": [1, 2]}, {"ytd": [3, 5]}, {"parallel": [4]}]
    assert log.where("step = 'DEPENDENCIES TEST'").agg(F.sort_array(F.collect_list("object_id"))).first()[0] == [8, 9]
