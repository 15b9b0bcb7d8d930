"""Owners of replaced rows against trying every scope, counts of the writing pass, and what a store reads."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from chronoweave.operators.replace import (
    HEAD,
    RANGE,
    TAIL,
    Scope,
    owned_spans,
    replaced_counts,
    replacement,
    replacement_counts,
    with_owner,
    without_scopes,
)
from chronoweave.plans.store import FactStore

D = dt.date


def covers(s, site, activity, forecast, date):
    if (s.site_id, s.forecast_id) != (site, forecast) or s.activity_id not in (None, activity):
        return False
    if s.mode == TAIL:
        return date >= s.date_from
    return date < s.date_until if s.mode == HEAD else s.date_from <= date <= s.date_until


def random_scopes(draw, n):
    out = []
    for k in range(n):
        first = D(2024, 1, 1) + dt.timedelta(draw.randint(0, 60))
        mode = draw.choices([RANGE, TAIL, HEAD], [40, 1, 1])[0]
        last = first + dt.timedelta(draw.choice([-2, 0, 1, 5, 30]))
        out.append(Scope(1000 + k, draw.randint(1, 2), draw.randint(1, 2), first, last, draw.randint(1, 5), mode))
    return out


def test_owned_spans():
    draw = random.Random(2)
    for _ in range(200):
        spans = [(a := draw.randint(0, 20), a + draw.randint(-1, 8), k) for k in range(draw.randint(0, 8))]
        found = owned_spans(spans)
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
        for day in range(-1, 32):
            owner = min((k for a, b, k in spans if a <= day <= b), default=None)
            assert [k for a, b, k in found if a <= day <= b] == ([] if owner is None else [owner])


@pytest.mark.parametrize("n", [3, 1000])
def test_owners_of_overlapping_scopes(spark, day_facts, n):
    draw = random.Random(n)
    scopes = random_scopes(draw, n)
    days = [D(2023, 12, 20) + dt.timedelta(k) for k in range(100)]
    old = day_facts([(str(d), a, f, 1.0, None, s) for d in days[:: 3] for a in range(1, 7) for f in (1, 2) for s in (1, 2)])
    old = old.unionByName(old.limit(3).withColumn("site_id", F.lit(None).cast("int")))
    want = {}
    for r in old.collect():
        held = [s.import_id for s in scopes if r.site_id is not None and covers(s, r.site_id, r.activity_id, r.forecast_id, r.date)]
        want[r.site_id, r.activity_id, r.forecast_id, r.date] = held[0] if held else None
    got = with_owner(old, scopes).collect()
    assert len(got) == old.count()
    assert {(r.site_id, r.activity_id, r.forecast_id, r.date): r.owner for r in got} == want
    assert without_scopes(old, scopes).count() == sum(r.owner is None for r in got)
    counts = {r.import_id: r.rows_deleted for r in replaced_counts(old, scopes).collect()}
    assert sum(counts.values()) == sum(r.owner is not None for r in got) and all(counts.values())


def test_owners_of_filters_and_series_together(spark, day_facts):
    old = day_facts([("2024-01-01", a, 1, float(a)) for a in range(1, 6)])
    last = D(2024, 1, 31)
    scopes = [
        Scope(1, 1, 1, D(2024, 1, 1), last, None, filter="value1 > 3"),
        Scope(2, 1, 1, D(2024, 1, 1), last, 4),
        Scope(3, 1, 1, D(2024, 1, 1), last, 2),
        Scope(4, 1, 1, D(2024, 1, 1), last, None, filter="[value1] <= 2 and day_month = 1"),
        Scope(5, 1, 2, D(2024, 1, 1), last, None),
    ]
    got = {r.activity_id: r.owner for r in with_owner(old, scopes).collect()}
    assert got == {1: 4, 2: 3, 3: None, 4: 1, 5: 1}
    many = [Scope(n, 1, 1, D(2024, 1, 1), last, None, filter=f"value1 >= {n} and value1 < {n + 1}") for n in range(40)]
    assert {r.activity_id: r.owner for r in with_owner(old, many).collect()} == {a: a for a in range(1, 6)}
    assert with_owner(old, []).where("owner is not null").count() == 0


def test_counts_come_with_the_rows_written(spark, day_facts, tmp_path):
    draw = random.Random(5)
    old = day_facts([(str(D(2024, 1, 1) + dt.timedelta(k)), a, 1, 1.0) for k in range(90) for a in range(1, 30)])
    store = FactStore(spark, str(tmp_path / "d"))
    store.append(old)
    scopes = [Scope(500 + a, 1, 1, D(2024, 1, draw.randint(1, 20)), D(2024, 2, draw.randint(1, 28)), a) for a in range(1, 25)]
    new = day_facts([(str(s.date_from + dt.timedelta(k)), s.activity_id, 1, 2.0) for s in scopes for k in range(draw.randint(0, 3))])
    new = new.withColumn("import_id", F.col("activity_id") + 500)
    want = {r.import_id: (r.rows_deleted, r.rows_inserted) for r in replacement_counts(replacement(old, new, scopes)).collect()}
    deleted, added = store.replace(new, scopes)
    assert {i: (deleted.get(i, 0), added.get(i, 0)) for i in deleted.keys() | added.keys()} == want
    assert store.read().count() == old.count() - sum(deleted.values()) + sum(added.values())
    nothing = store.replace(new.limit(0), [Scope(1, 9, 9, D(2024, 1, 1), D(2024, 1, 2), 1)])
    assert nothing == ({}, {})


def test_old_rows_are_read_once_in_the_months_touched(spark, day_facts, tmp_path, monkeypatch):
    store = FactStore(spark, str(tmp_path / "d"))
    store.append(day_facts([(f"2024-{m:02}-01", 1, 1, 1.0) for m in range(1, 13)]))
    plans, write = [], FactStore._write

    def watched(self, rows, *more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, *more)

    monkeypatch.setattr(FactStore, "_write", watched)
    store.replace(day_facts([("2024-03-02", 1, 1, 1.0)]), [Scope(1, 1, 1, D(2024, 3, 1), D(2024, 3, 31), 1)])
    assert len(re.findall(r"FileScan parquet \[date", plans[0])) == 1
    assert "dynamicpruning" in plans[0]
    plan = store.where_days(D(2024, 5, 1), D(2024, 5, 31))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", plan)


def test_rows_without_a_site(spark, day_facts, tmp_path):
    store = FactStore(spark, str(tmp_path / "d"))
    rows = day_facts([("2024-01-01", 1, 1, 1.0), ("2024-01-02", 1, 1, 2.0)])
    store.append(rows.unionByName(rows.withColumn("site_id", F.lit(None).cast("int"))))
    for _ in range(3):
        store.replace(rows.limit(0), [Scope(1, 1, 1, D(2024, 1, 1), D(2024, 1, 31), 1)])
    assert [(r.site_id, r.value1) for r in store.read().orderBy("value1").collect()] == [(None, 1.0), (None, 2.0)]
