import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from chronoweave.functions.text import flag_set
from chronoweave.model import (
    DIM_ACTIVITY,
    DIM_FORECAST,
    DIM_TEMPLATE,
    FACT_DAY,
    FACT_INTRADAY,
    IMPORT,
    IMPORT_FILE,
    IMPORT_PROCEDURE,
    OPEN_FROM,
    OPEN_UNTIL,
    SOURCE_FILE,
    local_table,
)
from chronoweave.operators.copies import copy_files, copy_imports, number_by_id
from chronoweave.operators.replace import Scope
from chronoweave.plans.config import resolve_config, with_parameters
from chronoweave.plans.runner import Runner, Tables, totals
from chronoweave.plans.store import FactStore
from chronoweave.sources.views import labelled_values
from chronoweave.sources.staged import StagedFile, configured_files, read_staged_files

D = dt.date
NOW = dt.datetime(2024, 3, 15, 12, 0, tzinfo=dt.timezone.utc)
ACTIVE = {"active": True, "site_id": 1}


def config(spark, imports, procedures, activities=(1, 2, 3), forecasts=(1, 2, 3, 4, 5)):
    return Tables(
        imports=local_table(spark, [{**ACTIVE, **i} for i in imports], IMPORT),
        procedures=local_table(spark, [{**ACTIVE, **p} for p in procedures], IMPORT_PROCEDURE),
        activity=local_table(
            spark, [{"activity_id": a, "activity_name": f"a{a}", "domain": "x", **ACTIVE} for a in activities], DIM_ACTIVITY
        ),
        forecast=local_table(spark, [{"forecast_id": f, "forecast_name": f"f{f}", **ACTIVE} for f in forecasts], DIM_FORECAST),
    )


def source(spark, rows):
    return local_table(
        spark,
        [{"day": D.fromisoformat(d), "kind": k, "v": v} for d, k, v in rows],
        "day date, kind string, v double",
    )


def resolved_one(spark, imp, proc):
    t = config(
        spark,
        [{"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, **imp}],
        [{"procedure_id": 1, "procedure_name": " p ", "procedure_code": "import", **proc}],
    )
    return resolve_config(t.imports, t.procedures, t.activity, t.forecast, NOW.date()).first()


def test_defaults_overrides_and_filters(spark):
    r = resolved_one(
        spark,
        {"p1": "  ", "p2": " own ", "filter": " b=2 ", "commands": "-INTRADAY", "sort_order": None},
        {"p1": " shared ", "p2": "x", "filter": "a=1", "commands": " -NODELTA ", "sort_order": 3},
    )
    assert (r["p1"], r["p2"], r["fields_source"]) == ("shared", "own", "value1")
    assert r["filter"] == "a=1 AND (b=2)"
    assert flag_set(r["commands"]) == {"NODELTA", "INTRADAY"}
    assert r["sort_order"] == 3101
    assert (r["procedure_name"], r["active"]) == ("p", 1)


def test_window_priority(spark):
    r = resolved_one(spark, {}, {})
    assert (r["date_import_from"], r["date_import_until"]) == (OPEN_FROM, OPEN_UNTIL)
    r = resolved_one(spark, {"days_back": " 3 ", "days_forward": "x"}, {"date_import_from": NOW, "days_forward": "5"})
    assert (r["date_import_from"], r["date_import_until"]) == (D(2024, 3, 12), D(2024, 3, 20))
    r = resolved_one(
        spark, {"date_import_from": dt.datetime(2020, 5, 6, 9, tzinfo=dt.timezone.utc), "days_back": "3"}, {"days_back": "9"}
    )
    assert r["date_import_from"] == D(2020, 5, 6)


def test_json_parameters_override_the_window(spark):
    t = config(
        spark,
        [{"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1,
          "p1": '{"date_import_from":"2021-01-01","intraday_duration":"30"}'}],
        [{"procedure_id": 1, "procedure_name": "p", "procedure_code": "import"}],
    )
    rows = resolve_config(t.imports, t.procedures, t.activity, t.forecast, NOW.date())
    r = with_parameters(rows, '{"date_import_from":"2022-02-02","date_import_until":"never"}').first()
    assert (r["date_import_from"], r["date_import_until"], r["intraday_duration"]) == (D(2022, 2, 2), OPEN_UNTIL, 30)
    r = with_parameters(rows.withColumn("p1", F.lit("7"))).first()
    assert (r["source_import_id_field"], r["intraday_duration"]) == ("", 15)


def test_numbering_is_dense_and_ordered(spark):
    ids = spark.range(25).select((F.col("id") * 7001 + 3).cast("int").alias("k"))
    got = number_by_id(ids, "k", 100, "n").orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(100, 125))


def facts_of(store):
    return sorted(
        (str(r["date"]), r["activity_id"], r["forecast_id"], r["value1"], r["import_id"]) for r in store.read().collect()
    )


def places_of(store):
    return {tuple(r) for r in store.places().collect()}


def test_store_replaces_only_its_range(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "day"))
    assert store.read().count() == 0
    when = dt.datetime(2024, 1, 1)
    store.append(day_facts([("2024-01-31", 1, 1, 1.0), ("2024-02-01", 1, 1, 2.0), ("2024-02-02", 2, 1, 3.0), ("2024-02-01", 1, 2, 4.0)]))
    untouched = [p for p in places_of(store) if p[2] == 2]
    new = day_facts([("2024-02-03", 1, 1, 9.0)]).withColumns(
        {"import_id": F.lit(5), "date_updated": F.lit(when)}
    )
    scopes = [Scope(5, 1, 1, D(2024, 2, 1), D(2024, 2, 28), 1)]
    for _ in range(2):
        deleted, added = store.replace(new, scopes)
        assert (deleted, added) == ({5: 1}, {5: 1})
        assert [f[:4] for f in facts_of(store)] == [
            ("2024-01-31", 1, 1, 1.0), ("2024-02-01", 1, 2, 4.0), ("2024-02-02", 2, 1, 3.0), ("2024-02-03", 1, 1, 9.0),
        ]
    assert [p for p in places_of(store) if p[2] == 2] == untouched
    # A month left without rows disappears.
    store.replace(new.limit(0), [Scope(6, 1, 1, D(2024, 1, 1), D(2024, 1, 31), 1)])
    assert not [p for p in places_of(store) if p[2:4] == (1, 202401)]


def test_store_refuses_rows_outside_its_scopes(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "day"))
    store.append(day_facts([("2024-01-31", 1, 1, 1.0), ("2024-03-01", 1, 1, 2.0)]))
    new = day_facts([("2024-02-01", 1, 1, 7.0), ("2024-03-02", 1, 1, 8.0)])
    with pytest.raises(ValueError, match="outside"):
        store.replace(new, [Scope(1, 1, 1, D(2024, 2, 1), D(2024, 2, 28), 1)])
    assert [f[3] for f in facts_of(store)] == [1.0, 2.0]


def test_readers_see_a_replacement_at_once_or_not_at_all(spark, day_facts, tmp_path, monkeypatch):
    """A reader between any two steps of a replacement finds the facts before it or after it."""
    path = str(tmp_path / "day")
    store = FactStore(spark, path)
    store.append(day_facts([("2024-01-31", 1, 1, 1.0), ("2024-02-01", 1, 1, 2.0)]))
    new = day_facts([("2024-02-01", 1, 1, 7.0)])
    scopes = [Scope(1, 1, 1, D(2024, 1, 1), D(2024, 2, 28), 1)]
    seen, held = [], store.read()

    def watched(name):
        own = getattr(FactStore, name)

        def step(self, *args):
            seen.append([f[3] for f in facts_of(FactStore(spark, path))])
            out = own(self, *args)
            seen.append([f[3] for f in facts_of(FactStore(spark, path))])
            return out

        return step

    with monkeypatch.context() as m:
        for name in ("_write", "_commit", "_forget"):
            m.setattr(FactStore, name, watched(name))
        store.replace(new, scopes)
    assert seen[:3] == [[1.0, 2.0]] * 3 and seen[3:] == [[7.0]] * 3
    assert sorted(r["value1"] for r in held.collect()) == [1.0, 2.0]  # a plan made before still runs


def test_a_lost_writer_leaves_nothing_but_files(spark, day_facts, tmp_path, monkeypatch):
    store = FactStore(spark, str(tmp_path / "day"))
    store.append(day_facts([("2024-01-31", 1, 1, 1.0)]))
    with monkeypatch.context() as m:
        m.setattr(FactStore, "_commit", lambda self, places: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.append(day_facts([("2024-01-31", 1, 1, 9.0)]))
    assert [f[3] for f in facts_of(FactStore(spark, store.path))] == [1.0]
    versions = tmp_path / "day"
    assert len(list(versions.glob("version=*"))) == 2
    store.recover()
    assert len(list(versions.glob("version=*"))) == 1 and [f[3] for f in facts_of(store)] == [1.0]


def test_old_versions_go(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "day"))
    scopes = [Scope(1, 1, 1, D(2024, 1, 1), D(2024, 1, 31), 1)]
    for n in range(4):
        store.replace(day_facts([("2024-01-01", 1, 1, float(n))]), scopes)
    assert [f[3] for f in facts_of(store)] == [3.0]
    assert len(store._numbers()) == 2 and len(list((tmp_path / "day").glob("version=*/site_id=1/*/*/*"))) == 2


def make_runner(spark, tmp_path, tables, **more):
    return Runner(
        spark, tables, FactStore(spark, str(tmp_path / "day")), FactStore.intraday(spark, str(tmp_path / "quarter")),
        str(tmp_path / "log"), NOW, **more,
    )


SALES = [("2024-01-01", "a", 1.0), ("2024-01-01", "a", 2.0), ("2024-01-02", "b", 4.0), ("2024-02-05", "a", 8.0)]


def sales_config(spark, *extra_imports, procedures=()):
    imports = [
        {"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "kind='a'"},
        {"import_id": 2, "procedure_id": 1, "activity_id": 2, "forecast_id": 1, "filter": "kind='b'"},
        *extra_imports,
    ]
    shared = {
        "procedure_id": 1, "procedure_name": "SALES", "procedure_code": "import", "source": "sales",
        "group_by": "day", "fields_source": "sum(v)", "fields_target": "value1", "app": "SP", "status": "TEST",
        "sort_order": 1,
    }
    tables = config(spark, imports, [shared, *procedures])
    tables.sources["sales"] = source(spark, SALES)
    return tables


def test_import_then_ytd_through_the_batch(spark, tmp_path):
    ytd = {"procedure_id": 2, "procedure_name": "YTD", "procedure_code": "legacy ytd", "p1": "1", "p2": "month",
           "app": "SP", "status": "TEST", "sort_order": 2}
    broken = {"procedure_id": 3, "procedure_name": "BROKEN", "procedure_code": "unknown", "app": "SP", "status": "TEST", "sort_order": 0}
    tables = sales_config(
        spark,
        {"import_id": 3, "procedure_id": 2, "activity_id": 1, "forecast_id": 4},
        {"import_id": 4, "procedure_id": 2, "activity_id": 2, "forecast_id": 5, "filter": "domain='x'"},
        procedures=(ytd, broken),
    )
    runner = make_runner(spark, tmp_path, tables, codes={"legacy ytd": "ytd"})
    for _ in range(2):
        results = runner.run_all(commands="-LOG_ROWCOUNT -LOG_IMPORTS")
        assert facts_of(runner.day) == [
            ("2024-01-01", 1, 1, 3.0, 1), ("2024-01-01", 1, 4, 3.0, 3), ("2024-01-01", 1, 5, 3.0, 4),
            ("2024-01-02", 2, 1, 4.0, 2), ("2024-01-02", 2, 5, 4.0, 4),
            ("2024-02-05", 1, 1, 8.0, 1), ("2024-02-05", 1, 4, 11.0, 3), ("2024-02-05", 1, 5, 11.0, 4),
        ]
    assert list(results) == ["BROKEN", "SALES", "YTD"]
    assert results["BROKEN"]["Errors"] == 1
    assert results["SALES"] == {"Imports": 2, "Errors": 0, "Warnings": 0, "Deleted": 3, "Inserted": 3, "Updated": 0}
    assert results["YTD"]["Deleted"] == 5 and results["YTD"]["Inserted"] == 5
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.where("step = 'INSERT DAY' and object = 'import'").agg(F.sum("value")).first()[0] == 6
    ends = log.where("step = 'END' and object = 'ytd'").orderBy("logged").collect()
    assert json.loads(ends[0]["data"])["Inserted"] == 5


def test_one_bad_import_does_not_stop_the_others(spark, tmp_path):
    tables = sales_config(
        spark,
        {"import_id": 3, "procedure_id": 1, "activity_id": 3, "forecast_id": 1, "filter": "no_such_column=1"},
        {"import_id": 4, "procedure_id": 1, "activity_id": 3, "forecast_id": 2, "schedule": "day_week = 1"},
        {"import_id": 5, "procedure_id": 1, "activity_id": 3, "forecast_id": 3, "schedule": "day_week = 5 and month(getdate()) = 3"},
        {"import_id": 6, "procedure_id": 1, "activity_id": 3, "forecast_id": 4, "schedule": "syntax error here ("},
        {"import_id": 7, "procedure_id": 1, "activity_id": 3, "forecast_id": 5, "filter": "kind='none'"},
    )
    runner = make_runner(spark, tmp_path, tables)
    done = {o.run.import_id: o for o in runner.run("import")}
    assert {i: o.errors for i, o in done.items()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 1, 7: 0}
    assert {i: o.inserted for i, o in done.items()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: 3, 6: 0, 7: 0}
    assert done[4].warnings == 1 and done[7].warnings == 1
    forced = {o.run.import_id: o for o in runner.run("import", import_id=4, commands="-NOSCHEDULE")}
    assert forced[4].inserted == 3
    failed = [r for r in runner.log.rows if r["result"] == "Failed" and r["step"] == "INSERT DAY"]
    assert failed and "no_such_column" in json.loads(failed[0]["data"])["Message"]


def test_later_import_of_a_series_replaces_the_earlier(spark, tmp_path):
    tables = sales_config(
        spark, {"import_id": 3, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "kind='b'"}
    )
    runner = make_runner(spark, tmp_path, tables)
    done = runner.run("import", activity_id=1)
    # Import 3 covers 2 January only, so both days of import 1 stay.
    assert [(f[0], f[4]) for f in facts_of(runner.day)] == [("2024-01-01", 1), ("2024-01-02", 3), ("2024-02-05", 1)]
    assert totals(done)["Inserted"] == 3


def test_dry_run_keeps_the_plan_and_writes_nothing(spark, tmp_path):
    runner = make_runner(spark, tmp_path, sales_config(spark))
    done = runner.run("import", commands="-PRINT -LOG_QUERY")
    assert totals(done)["Inserted"] == 0 and runner.day.read().count() == 0
    (plan,) = runner.plans.values()
    assert plan.count() == 3
    assert any(r["result"] == "Debug" for r in runner.log.rows)


def test_selection_by_name_and_json(spark, tmp_path):
    runner = make_runner(spark, tmp_path, sales_config(spark))
    assert runner.run("import", procedure_name="NOPE%") == []
    done = runner.run("import", procedure_name="SAL%", p='{"date_import_from":"2024-02-01"}')
    assert totals(done)["Inserted"] == 1
    assert runner.run("import", procedure_name="1", activity_id=2)[0].run.import_id == 2


def test_source_marking_and_intraday(spark, tmp_path):
    tables = config(
        spark,
        [{"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "v > 1",
          "commands": "-SOURCE_FILTER_IMPORT -INTRADAY", "p1": '{"intraday_duration":"30"}'}],
        [{"procedure_id": 1, "procedure_name": "E", "procedure_code": "import", "source": "events",
          "group_by": "day", "fields_source": "sum(v)", "fields_target": "value1"}],
    )
    tables.sources["events"] = source(spark, SALES).withColumns(
        {"interval_id": F.col("v").cast("int"), "import_id": F.lit(None).cast("int")}
    )
    seen = []
    runner = make_runner(spark, tmp_path, tables, on_source_update=lambda name, df: seen.append(name))
    (done,) = runner.run("import")
    assert (done.updated, done.inserted, seen) == (3, 6, ["events"])
    quarter = runner.intraday.read().orderBy("date").collect()
    assert [(r["interval_id"], r["value1"], r["duration_min"]) for r in quarter] == [(2, 2.0, 30), (4, 4.0, 30), (8, 8.0, 30)]
    marked = tables.sources["events"].where("import_id = 1").count()
    assert marked == 3


def marking_config(spark, source_name, flags="", second="kind='b'"):
    imports = [
        {"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "kind='a'"},
        {"import_id": 2, "procedure_id": 1, "activity_id": 2, "forecast_id": 1, "filter": second},
    ]
    procedure = {
        "procedure_id": 1, "procedure_name": "M", "procedure_code": "import", "source": source_name, "group_by": "day",
        "fields_source": "sum(v)", "fields_target": "value1", "commands": f"-SOURCE_FILTER_IMPORT {flags}",
    }
    return config(spark, imports, [procedure])


@pytest.mark.parametrize("name", ["[src]", "src"])
def test_marks_stay_for_the_next_runner(spark, tmp_path, name):
    tables = marking_config(spark, name, "-SOURCE_UPDATE_NULL")
    tables.sources["src"] = source(spark, SALES).withColumn("import_id", F.lit(None).cast("int"))
    done = make_runner(spark, tmp_path, tables).run("import")
    assert [o.updated for o in done] == [3, 1] and [o.inserted for o in done] == [2, 1]
    again = make_runner(spark, tmp_path, tables).run("import")
    assert [o.updated for o in again] == [0, 0] and [o.inserted for o in again] == [2, 1]


def test_marks_of_a_catalog_table_are_stored(spark, tmp_path):
    rows = source(spark, SALES).withColumn("import_id", F.lit(None).cast("int"))
    rows.write.option("path", str(tmp_path / "marked_sales")).saveAsTable("marked_sales")
    try:
        done = make_runner(spark, tmp_path, marking_config(spark, "[marked_sales]", "-SOURCE_UPDATE_NULL")).run("import")
        assert [o.updated for o in done] == [3, 1]
        got = spark.table("marked_sales").groupBy("import_id").count().collect()
        assert sorted(map(tuple, got)) == [(1, 3), (2, 1)]
    finally:
        spark.sql("DROP TABLE marked_sales")


def test_marks_of_the_day_facts_are_stored(spark, day_facts, tmp_path):
    tables = config(
        spark,
        [{"import_id": 7, "procedure_id": 1, "activity_id": 1, "forecast_id": 3, "filter": "forecast_id=1",
          "commands": "-SOURCE_FILTER_IMPORT -SOURCE_UPDATE_NULL"}],
        [{"procedure_id": 1, "procedure_name": "F", "procedure_code": "import", "fields_source": "sum(value1)", "fields_target": "value1"}],
    )
    runner = make_runner(spark, tmp_path, tables)
    runner.day.append(day_facts([("2024-01-01", 1, 1, 1.0), ("2024-02-01", 2, 1, 2.0)]).withColumn("import_id", F.lit(None).cast("int")))
    (done,) = runner.run("import")
    assert (done.errors, done.updated, done.inserted) == (0, 2, 2)
    assert [f[4] for f in facts_of(FactStore(spark, runner.day.path))] == [7] * 4
    (again,) = make_runner(spark, tmp_path, tables).run("import")
    assert (again.updated, again.inserted) == (0, 2)


def test_updated_counts_survive_a_retry(spark, tmp_path):
    tables = marking_config(spark, "src", "-SOURCE_UPDATE_NULL")
    tables.sources["src"] = source(spark, SALES).withColumn("import_id", F.lit(None).cast("int"))
    tables.imports = tables.imports.withColumn(
        "fields_source", F.when(F.col("import_id") == 2, F.lit("no_such_function(v)"))
    )
    done = {o.run.import_id: o for o in make_runner(spark, tmp_path, tables).run("import")}
    assert (done[1].errors, done[1].updated, done[1].inserted) == (0, 3, 2)
    assert done[2].errors == 1


def test_attributes_that_users_keep_per_date(spark, day_facts, tmp_path):
    """An alert by a kept attribute, and a year-to-date whose filter replaces by another."""
    procedures = [
        {"procedure_id": 1, "procedure_name": "al", "procedure_code": "alert", "group_by": "year_next_week_fc", "filter": "forecast_id=1", "p3": "value > 5"},
        {"procedure_id": 2, "procedure_name": "yt", "procedure_code": "ytd", "p1": "1", "p2": "month", "filter": "season = 'low' and year = 2024"},
    ]
    window = {
        "date_import_from": dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc),
        "date_import_until": dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc),
    }
    imports = [{"import_id": n, "procedure_id": n, "activity_id": 1, "forecast_id": 3 + n, **window} for n in (1, 2)]
    tables = config(spark, imports, procedures)
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(9)]
    tables.dates = spark.createDataFrame(
        [(d, 202401 + i // 7, "low" if i < 3 else "high") for i, d in enumerate(days)],
        "date date, year_next_week_fc int, season string",
    )
    runner = make_runner(spark, tmp_path, tables)
    runner.day.append(day_facts([(str(d), 1, 1, 1.0) for d in days]))
    (alerted,) = runner.run("alert")
    assert (alerted.errors, alerted.inserted) == (0, 1)
    assert [f for f in facts_of(runner.day) if f[2] == 4] == [("2024-01-01", 1, 4, 7.0, 1)]
    for deleted in (0, 1):
        (done,) = runner.run("ytd")
        assert (done.errors, done.deleted, done.inserted) == (0, deleted, 1)
    assert [f for f in facts_of(runner.day) if f[2] == 5] == [("2024-01-03", 1, 5, 3.0, 2)]


def test_every_derived_series_through_the_runner(spark, day_facts, tmp_path):
    def procedure(n, code, **more):
        return {"procedure_id": n, "procedure_name": code, "procedure_code": code, "app": "SP", "status": "TEST", "sort_order": n, **more}

    procedures = [
        procedure(1, "ytd", p1="1", p2="w"),
        procedure(2, "parallel", p1="1", p2="month", p5="1"),
        procedure(3, "split", fields_target="value2"),
        procedure(4, "correlation", p2="1", p3="2", p4="1", p5="2"),
        procedure(5, "regression", p1="file_id = 417", filter="forecast_id=1", fields_source="value1,value8", fields_target="value1,value2"),
        procedure(6, "regression_simple", p1="[file_id]=418", filter="forecast_id=1 and activity_id=1"),
        procedure(7, "alert", p2="forecast_id=2", p3="dif_pct > 0.1", group_by="[year_week]"),
    ]
    window = {
        "date_import_from": dt.datetime(2023, 6, 1, tzinfo=dt.timezone.utc),
        "date_import_until": dt.datetime(2024, 2, 29, tzinfo=dt.timezone.utc),
    }
    imports = [
        {"import_id": 10 + n, "procedure_id": n, "activity_id": 1, "forecast_id": 10 + n, **window, **more}
        for n, more in (
            (1, {"filter": "domain = 'x'"}), (2, {"filter": "A.activity_name like 'a%'"}),
            (3, {"source": "100 200,5 300 400 500 600 700", "filter": "activity_id=1 and forecast_id=1 and year=2023"}),
            (4, {"p1": "2"}), (5, {}), (6, {}), (7, {"filter": "forecast_id=1"}),
        )
    ] + [
        {"import_id": 30, "procedure_id": 4, "activity_id": 2, "forecast_id": 20, **window},
        {"import_id": 31, "procedure_id": 5, "activity_id": 3, "forecast_id": 15, **window},
        {"import_id": 32, "procedure_id": 3, "activity_id": 1, "forecast_id": 21, **window},
    ]
    tables = config(spark, imports, procedures, forecasts=range(1, 22))
    tables.activity = tables.activity.withColumn("parent", F.when(F.col("activity_id") == 1, F.lit("1")))
    start = D(2023, 1, 2)
    facts = [
        (str(start + dt.timedelta(days=i)), a, f, float(5 + (i * a) % 7 + f))
        for i in range(400) for a in (1, 2) for f in (1, 2)
    ]
    letters = "ABCDEFGHIJKLMNOP"
    lag_rows = [[1, "n", f"cat{k}", 0.1, 0.5, *[0.1] * 6, 1.0] for k in range(5)]
    lag_rows += [[3, "n", "cat0", *[0.1] * 8, 1.0]] * 2
    simple_rows = [[1, "n", "c0", 0.1, 0, *[0.1] * 11]]
    staged = [dict(zip(letters, map(str, r))) | {"file_id": 417} for r in lag_rows]
    staged += [dict(zip(letters, map(str, r))) | {"file_id": 418} for r in simple_rows]
    tables.staged = local_table(spark, staged, "file_id int, " + ", ".join(f"{c} string" for c in letters))
    runner = make_runner(spark, tmp_path, tables)
    runner.day.append(day_facts(facts))
    first = runner.run_all()
    assert {n: r["Errors"] for n, r in first.items()} == {
        "ytd": 0, "parallel": 0, "split": 1, "correlation": 1, "regression": 1, "regression_simple": 0, "alert": 0,
    }
    assert all(r["Inserted"] > 0 and r["Deleted"] == 0 for r in first.values())
    before = facts_of(runner.day)
    again = runner.run_all()
    assert {n: (r["Deleted"], r["Inserted"]) for n, r in again.items()} == {
        n: (r["Inserted"], r["Inserted"]) for n, r in first.items()
    }
    assert facts_of(runner.day) == before
    messages = [json.loads(r["data"])["Message"] for r in runner.log.rows if r["step"] == "PARAMETERS TEST"]
    for word in ("driver", "totals", "repeated"):
        assert any(word in m for m in messages)


def test_reports_in_sql(spark, tmp_path):
    runner = make_runner(spark, tmp_path, sales_config(spark))
    runner.run("import")
    runner.create_views()
    rows = spark.sql(
        "select activity_name, YYYYMM, sum(value1) as v from fact_day_view "
        "where date_view >= first_day_current_year(getdate()) group by all order by 1, 2"
    ).collect()
    assert [tuple(r) for r in rows] == [("a1", "202401", 3.0), ("a1", "202402", 8.0), ("a2", "202401", 4.0)]
    assert spark.table("import_run").count() == 2 and spark.table("fact_intraday_view").count() == 0


def split_config(spark, first, last):
    window = {
        "date_import_from": first and dt.datetime(*first, tzinfo=dt.timezone.utc),
        "date_import_until": last and dt.datetime(*last, tzinfo=dt.timezone.utc),
    }
    return config(
        spark,
        [{"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 5, "source": "100", "filter": "forecast_id=1", **window}],
        [{"procedure_id": 1, "procedure_name": "s", "procedure_code": "split", "app": "SP", "status": "TEST"}],
    )


@pytest.mark.parametrize("year", [1985, 2055])
def test_split_far_from_today_writes_what_it_deletes(spark, day_facts, tmp_path, year):
    runner = make_runner(spark, tmp_path, split_config(spark, (year, 1, 1), (year, 12, 31)))
    runner.day.append(day_facts([("2023-01-01", 1, 1, 1.0), ("2023-01-02", 1, 1, 3.0), (f"{year}-01-05", 1, 5, 9.0)]))
    done = runner.run("split")[0]
    assert (done.errors, done.deleted, done.inserted) == (0, 1, 2)
    assert [f for f in facts_of(runner.day) if f[2] == 5] == [(f"{year}-01-01", 1, 5, 25.0, 1), (f"{year}-01-02", 1, 5, 75.0, 1)]


def test_open_split_needs_a_calendar(spark, day_facts, tmp_path):
    facts = [("2023-01-01", 1, 1, 1.0), ("2023-01-02", 1, 1, 3.0), ("1950-01-05", 1, 5, 9.0)]
    runner = make_runner(spark, tmp_path, split_config(spark, None, None))
    runner.day.append(day_facts(facts))
    before = facts_of(runner.day)
    assert runner.run("split")[0].errors == 1 and facts_of(runner.day) == before
    closed = make_runner(spark, tmp_path, split_config(spark, None, None), calendar=(D(2030, 1, 1), D(2030, 12, 31)))
    assert closed.run("split")[0].inserted == 2 and len(facts_of(closed.day)) == len(before) + 2


def test_views_hold_after_a_run(spark, tmp_path):
    runner = make_runner(spark, tmp_path, sales_config(spark))
    runner.run("import")
    runner.create_views()
    runner.run("import")
    assert spark.sql("select count(*) from fact_day_view").first()[0] == len(facts_of(runner.day))


def test_copy_with_series_is_repeatable(spark, tmp_path):
    runner = make_runner(spark, tmp_path, sales_config(spark))
    runner.run("import")
    for _ in range(2):
        copies = runner.copy_imports("1,2", 3, 50, "-DATADAY")
        assert sorted((r["old_import_id"], r["import_id"]) for r in copies.collect()) == [(1, 50), (2, 51)]
        assert [f for f in facts_of(runner.day) if f[2] == 3] == [
            ("2024-01-01", 1, 3, 3.0, 50), ("2024-01-02", 2, 3, 4.0, 51), ("2024-02-05", 1, 3, 8.0, 50),
        ]


def test_copied_imports_get_new_guids(spark):
    t = config(spark, [{"import_id": 4, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "import_guid": "g"}],
               [{"procedure_id": 1, "procedure_name": "p", "procedure_code": "import"}])
    row = copy_imports(t.imports, " 4, 5", 2, 10, NOW).first()
    assert (row["import_id"], row["forecast_id"]) == (10, 2) and row["import_guid"] != "g"


def test_copied_files_keep_their_creation(spark):
    created = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    rows = [
        {"file_id": i, "category": "c", "site_id": s, "forecast_id": 3, "file_guid": "g", "date_created": created}
        for i, s in ((1, 1), (2, 2), (3, 1))
    ]
    files = local_table(spark, rows, IMPORT_FILE)
    copies = copy_files(files, "1, 2,3", 1, 10, None, "", "s", NOW).orderBy("file_id").collect()
    assert [(r["file_id"], r["category"], r["forecast_id"], r["session"]) for r in copies] == [(10, "c", 3, "s"), (11, "c", 3, "s")]
    assert all(r["date_created"] == created.replace(tzinfo=None) and r["file_guid"] != "g" for r in copies)
    renamed = copy_files(files, "2", 2, 20, 4, "2025").first()
    assert (renamed["category"], renamed["forecast_id"]) == ("c2025", 4)


def test_labelled_values_follow_the_template(spark, day_facts):
    facts = day_facts([("2024-01-01", 1, 1, 5.0, 6.0), ("2024-01-01", 2, 1, 7.0)])
    activity = local_table(spark, [{"activity_id": a, "template_id": a} for a in (1, 2)], DIM_ACTIVITY)
    template = local_table(
        spark, [{"template_id": 1, "value1": "calls", "value2": "cost", "value2_description": "in euro"}], DIM_TEMPLATE
    )
    rows = labelled_values(facts, activity, template).collect()
    assert sorted((r["value_name"], r["value_description"] or "", r["value"]) for r in rows) == [
        ("calls", "", 5.0), ("cost", "in euro", 6.0),
    ]


def test_staged_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title\nday,amount\n03-01-2024,\"1,5\"\n\n04-01-2024,x\n")
    (tmp_path / "b.txt").write_text("2024-01-05;7;extra\n")
    files = [
        StagedFile(str(tmp_path / "a.csv"), 1, "A", rows_skip=2, field_date="A", field_date_format="dd-MM-yyyy"),
        StagedFile(str(tmp_path / "b.txt"), 2, "B", site_id=3, fields="A,B", field_date="a", separator=";"),
    ]
    rows = read_staged_files(spark, files, "s")
    assert rows.columns == SOURCE_FILE.names
    got = sorted((r["file_id"], str(r["date"])[:10], r["B"], r["C"], r["site_id"]) for r in rows.collect())
    assert got == [(1, "2024-01-03", "1,5", None, 1), (1, "2024-01-04", "x", None, 1), (2, "2024-01-05", "7", None, 3)]


def test_staged_columns_past_the_last_are_an_error(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(",".join(map(str, range(80))) + "\n")
    with pytest.raises(Exception, match="more columns than BZ"):
        read_staged_files(spark, [StagedFile(str(tmp_path / "wide.csv"), 1)]).collect()


def test_quoted_line_breaks_and_configured_files(spark, tmp_path):
    (tmp_path / "q.csv").write_text('title\nday,note,n\n2024-01-03,"x\ny ""z""",1\n2024-01-04,b,2\n')
    rows = [
        {"file_id": 9, "file_name": "q.csv", "source": "Q", "rows_skip": 2, "fields": "A,B", "field_date": "a", "active": True,
         "site_id": 4, "forecast_id": 3},
        {"file_id": 10, "file_name": "gone.csv", "active": False},
    ]
    files = configured_files(local_table(spark, rows, IMPORT_FILE), str(tmp_path), multi_line=True)
    assert [(f.file_id, f.rows_skip, f.site_id, f.forecast_id, f.field_date_format) for f in files] == [(9, 2, 4, 3, "yyyy-MM-dd")]
    got = sorted((str(r["date"])[:10], r["B"], r["C"], r["source"]) for r in read_staged_files(spark, files).collect())
    assert got == [("2024-01-03", 'x\ny "z"', None, "Q"), ("2024-01-04", "b", None, "Q")]


def test_split_reads_the_months_of_its_filter(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "s"))
    store.append(day_facts([(f"{y}-{m:02}-01", 1, 1, 1.0) for y in (2022, 2023) for m in (1, 2)]))
    for text, n in (("year = 2022", 2), ("year_month = 202301", 1)):
        rows = store.read_by_month().where(text)
        assert rows.count() == n
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.inputFiles() and re.search(r"PartitionFilters: \[[^\]]*year_month", plan)


def test_only_months_of_each_scope_are_touched(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "s"))
    store.append(day_facts([(f"20{y:02}-01-01", 1, 1, 1.0) for y in range(1, 24)]))
    store.append(day_facts([("2001-01-01", 2, 1, 1.0)]))
    scopes = [Scope(n, 1, 1, D(y, 1, 1), D(y, 1, 31), 1) for n, y in ((1, 2001), (2, 2023))]
    before = places_of(store)
    store.replace(day_facts([]), scopes)
    assert len(before - places_of(store)) == 2


def test_fact_schemas():
    assert FACT_DAY["date"].nullable is False
    assert set(FACT_INTRADAY.names) - set(FACT_DAY.names) == {"interval_id", "duration_min"}


@pytest.mark.parametrize("mode,months", [("range", (202402, 202403)), ("tail", (202402, 999912)), ("head", (0, 202403))])
def test_scope_months(mode, months):
    from chronoweave.plans.store import _months

    assert _months(Scope(1, 1, 1, D(2024, 2, 1), D(2024, 3, 1), 1, mode)) == months
