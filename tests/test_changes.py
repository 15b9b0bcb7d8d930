"""Derived series after a change: only the days it reaches, with the facts of a full run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chronoweave.model import DIM_ACTIVITY, Run, local_table
from chronoweave.operators import alert, correlation, parallel, ytd
from chronoweave.operators.replace import HEAD, Scope, replace_range
from chronoweave.plans.changes import Change, change_of, derived_scope, narrowed
from chronoweave.plans.runner import Runner, Tables
from chronoweave.plans.store import FactStore

D, WHEN = dt.date, dt.datetime(2024, 1, 1)


def derive(operator, facts, runs, activity):
    if operator == "ytd":
        return ytd.year_to_date(facts, runs, activity, WHEN)
    if operator == "parallel":
        return parallel.parallel_period(facts, runs, activity, WHEN)
    return alert.alert_series(facts, runs, activity, WHEN)


RUNS = {
    "ytd": [
        Run(1, 1, 5, p1="1", p2="month"), Run(2, 2, 5, p1="1", p2="week", date_from=D(2021, 2, 10), date_until=D(2022, 11, 5)),
        Run(3, 3, 6, p1="1", p2="month", filter="segment = 'x'"), Run(4, 3, 7, p1="2", p2="month"),
    ],
    "parallel": [
        Run(1, 1, 5, p1="1", p5="1", date_from=D(2021, 1, 1), date_until=D(2023, 12, 31)),
        Run(2, 2, 6, p1="1", p2="m", p5="2", date_from=D(2021, 1, 1), date_until=D(2024, 12, 31), filter="segment = 'x'"),
    ],
    "alert": [
        Run(1 + n, 1 + n, 9, filter="forecast_id = 1 and activity_id < 4", p2="forecast_id = 1 and value1 > 3", p3="benchmark < 0.8 * value",
            group_by=g, date_from=D(2021, 1, 6), date_until=D(2022, 11, 20))
        for n, g in enumerate(("", "year_week", "[year_month]", "year_quarter", "year_week_short", "day_week"))
    ],
}


@pytest.mark.parametrize("operator", list(RUNS))
@pytest.mark.parametrize("seed", [1, 2])
def test_only_the_days_reached_give_the_facts_of_a_full_run(spark, day_facts, operator, seed):
    draw = random.Random(seed)
    activity = local_table(spark, [{"activity_id": a, "segment": "x" if a > 1 else "y"} for a in (1, 2, 3)], DIM_ACTIVITY)
    days = [D(2020, 12, 1) + dt.timedelta(k) for k in range(0, 760)]
    old = day_facts([(str(d), a, 1, float(draw.randint(1, 9))) for d in days for a in (1, 2, 3) if draw.random() < 0.5]).cache()
    first = D(2021, 1, 1) + dt.timedelta(draw.randint(0, 600))
    scopes = [Scope(50, 1, 1, first, first + dt.timedelta(draw.randint(0, 45)), draw.randint(1, 3)) for _ in range(1 + seed % 2)]
    new = day_facts([(str(s.date_from + dt.timedelta(k)), s.activity_id, 1, 20.0) for s in scopes for k in range(0, (s.date_until - s.date_from).days, 3)])
    changed = replace_range(old, new, scopes).cache()
    runs = RUNS[operator]
    concerned = [n for r in runs if (n := narrowed(operator, r, [change_of(s) for s in scopes]))]
    assert concerned and not any(r.import_id == 4 and operator == "ytd" for r in concerned)
    spans = [parallel.source_span(r) if operator == "parallel" else (r.date_from, r.date_until) for r in concerned]
    read = changed.where(F.col("date").between(min(s[0] for s in spans), max(s[1] for s in spans)))
    stored = replace_range(
        derive(operator, old, runs, activity), derive(operator, read, concerned, activity),
        [derived_scope(operator, r) for r in concerned], activity,
    )
    wanted = derive(operator, changed, runs, activity)
    assert sorted(map(str, stored.collect())) == sorted(map(str, wanted.collect()))


def test_days_reached():
    change = Change(1, 1, 7, D(2022, 12, 30), D(2023, 1, 3))

    def span(operator, **more):
        found = narrowed(operator, Run(1, 7, 5, p1="1", **more), [change])
        return found and (str(found.date_from), str(found.date_until))

    assert span("ytd", p2="month") == ("2022-01-01", "2023-12-31")
    assert span("ytd", p2="week") == ("2022-01-03", "2023-12-31")
    assert span("ytd", p2="week", date_from=D(2023, 2, 1), date_until=D(2023, 3, 1)) == ("2023-02-01", "2023-03-01")
    assert span("ytd", date_until=D(2021, 12, 31)) is None and span("ytd", site_id=2) is None
    assert span("alert", filter="activity_id = 3", group_by="year_month") == ("2022-12-01", "2023-01-31")
    assert span("alert", filter="value1 > 1", group_by="weeks_2000") == ("2022-12-26", "2023-01-08")
    assert span("alert", filter="activity_id = 3", group_by="mod(year, 4)", date_until=D(2030, 1, 1)) == ("1900-01-01", "2030-01-01")
    assert span("split", filter="year = 2022", date_from=D(2030, 1, 1), date_until=D(2030, 2, 1)) == ("2030-01-01", "2030-02-01")
    assert span("correlation", p2="1", p3="2") == ("1900-01-01", "9999-01-01") and span("correlation", p2="3", p3="4") is None
    assert span("regression", filter="forecast_id = 1", parent="8") is None and span("regression", filter="forecast_id = 1", parent="7")
    assert narrowed("ytd", Run(1, 7, 5, p1="1"), []) is None
    head = change_of(Scope(1, 1, 1, D(2020, 1, 1), D(2021, 1, 1), 7, HEAD))
    assert narrowed("ytd", Run(1, 7, 5, p1="1"), [head]).date_until == D(2021, 12, 31)


def test_a_run_of_changes_reads_and_writes_their_months_alone(spark, day_facts, tmp_path, monkeypatch):
    from test_plans import NOW, config, facts_of, source

    shared = {"app": "SP", "status": "TEST"}
    procedures = [
        {"procedure_id": 1, "procedure_name": "SALES", "procedure_code": "import", "source": "sales", "group_by": "day", "sort_order": 1,
         "fields_source": "sum(v)", "fields_target": "value1", **shared},
        {"procedure_id": 2, "procedure_name": "YTD", "procedure_code": "ytd", "p1": "1", "p2": "month", "sort_order": 2, **shared},
    ]
    imports = [
        {"import_id": 1, "procedure_id": 1, "activity_id": 1, "forecast_id": 1, "filter": "kind='a'"},
        {"import_id": 3, "procedure_id": 2, "activity_id": 1, "forecast_id": 4},
        {"import_id": 4, "procedure_id": 2, "activity_id": 2, "forecast_id": 4},
    ]

    def runner(folder):
        tables = config(spark, imports, procedures)
        tables.sources["sales"] = source(spark, [("2023-05-01", "a", 4.0), ("2023-06-01", "a", 8.0)])
        store = FactStore(spark, str(tmp_path / folder))
        old = [("2022-05-01", 1, 1, 1.0), ("2023-04-01", 1, 1, 2.0), ("2023-05-01", 1, 1, 3.0), ("2022-01-01", 2, 1, 9.0)]
        ytds = [("2022-05-01", 1, 4, 1.0), ("2023-04-01", 1, 4, 2.0), ("2023-05-01", 1, 4, 5.0), ("2022-01-01", 2, 4, 9.0)]
        rows = day_facts(old + ytds)
        store.append(rows.withColumn("import_id", F.when(F.col("forecast_id") == 1, 1).otherwise(F.col("activity_id") + 2)))
        return Runner(spark, tables, store, when=NOW)

    whole, part, read = runner("whole"), runner("part"), []
    whole.run_all()
    where_days = FactStore.where_days
    monkeypatch.setattr(FactStore, "where_days", lambda self, *days: read.append(days) or where_days(self, *days))
    results = part.run_all(changed_only=True)
    assert facts_of(part.day) == facts_of(whole.day)
    assert read == [(D(2023, 1, 1), D(2023, 12, 31))]
    assert results["YTD"]["Inserted"] == 3 and results["YTD"]["Warnings"] == 1
    assert {r[3] for r in part.day.places().select("version", "site_id", "forecast_id", "year_month").collect()} >= {202205}


def test_a_correlation_reads_the_months_it_needs(spark, day_facts, tmp_path, monkeypatch):
    store = FactStore(spark, str(tmp_path / "d"))
    draw = random.Random(3)
    weeks = [D(2012, 1, 2) + dt.timedelta(7 * k) for k in range(52 * 12)]
    facts = [(str(w + dt.timedelta(k)), a, f, float(draw.randint(1, 9))) for w in weeks for k in (0, 3) for a, f in ((1, 1), (2, 1), (2, 2))]
    store.append(day_facts(facts))
    runs = [Run(1, 1, 8, p1="2", p2="1", p3="2", p4=str(lag), date_from=D(2020, 3, 4), date_until=D(2020, 5, 5)) for lag in (0, 2)]
    runner = Runner(spark, Tables(None, None, None, None), store)
    near = runner._correlation_facts(runs)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan and near.agg(F.min("date"), F.max("date")).first()[0] > D(2016, 12, 1)
    whole = correlation.correlation_forecast(store.read(), runs, WHEN)
    assert sorted(map(str, correlation.correlation_forecast(near, runs, WHEN).collect())) == sorted(map(str, whole.collect()))
    # With a gap before the window the weeks before it are looked for further back.
    gap = FactStore(spark, str(tmp_path / "gap"))
    gap.append(day_facts([f for f in facts if not "2014-01" < f[0] < "2017-02"]))
    runner = Runner(spark, Tables(None, None, None, None), gap)
    got = correlation.correlation_forecast(runner._correlation_facts(runs), runs, WHEN)
    assert sorted(map(str, got.collect())) == sorted(map(str, correlation.correlation_forecast(gap.read(), runs, WHEN).collect()))
