import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from chronoweave.functions.text import flag_set
from chronoweave.model import Run, broadcast_if_small, local_table, measured_bytes
from chronoweave.operators.alert import alert_series
from chronoweave.operators.correlation import correlation_forecast
from chronoweave.operators.forecast_weeks import assign_forecast_weeks
from chronoweave.operators.imports import delta_windows, import_day, import_intraday
from chronoweave.operators.matching import Reading, match_filters
from chronoweave.operators.parallel import parallel_period
from chronoweave.operators.regression import regression_lag_categories, regression_simple
from chronoweave.operators import replace
from chronoweave.operators.replace import Scope, replace_range, replaced_counts, write_back
from chronoweave.operators.split import split_totals
from chronoweave.operators.ytd import year_to_date

D = dt.date


def days(first, values, activity=1, forecast=1, step=1):
    start = D.fromisoformat(first)
    return [
        (str(start + dt.timedelta(days=i * step)), activity, forecast, v) for i, v in enumerate(values)
    ]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [2, 48, 51, 480])
def test_any_number_of_filters_is_one_pass(spark, tmp_path, n):
    spark.range(5).write.parquet(str(tmp_path / "ids"))
    rows = match_filters(spark.read.parquet(str(tmp_path / "ids")), [f"id >= {i % 5}" for i in range(n)])
    assert executed(rows).count("FileScan") == 1
    counts = dict(rows.groupBy("filter_no").count().collect())
    assert counts == {i: 5 - i % 5 for i in range(n)}


@pytest.mark.parametrize("flags", [frozenset(), frozenset({"NOGROUPBY"})])
def test_one_filter_needs_no_nested_loop(spark, flags):
    source = spark.createDataFrame([(D(2024, 1, d), float(d)) for d in (1, 2, 3)], "date date, v double")
    field = "v" if flags else "sum(v)"
    runs = [
        Run(i, 10 + i, 1, filter="v > 0", fields_source=field, fields_target="value1", flags=flags,
            date_from=D(2024, 1, i), date_until=D(2024, 1, 3))
        for i in (1, 2)
    ]
    rows = import_day(source, runs)
    assert "NestedLoop" not in executed(rows) and "Cartesian" not in executed(rows)
    got = sorted((r["import_id"], r["activity_id"], r["date"].day, r["value1"], r["site_id"]) for r in rows.collect())
    assert got == [(1, 11, 1, 1.0, 1), (1, 11, 2, 2.0, 1), (1, 11, 3, 3.0, 1), (2, 12, 2, 2.0, 1), (2, 12, 3, 3.0, 1)]


def test_match_filters_counts(spark):
    n = 51
    rows = match_filters(spark.range(5), [f"id >= {i % 5}" for i in range(n)] + [""])
    counts = dict(rows.groupBy("filter_no").count().collect())
    assert counts == {**{i: 5 - i % 5 for i in range(n)}, n: 5}


def test_broadcast_only_after_measuring(spark):
    rows = spark.range(1000).select("id", F.repeat(F.lit("x"), 92).alias("text"))
    assert measured_bytes(rows) == 1000 * (16 + 92)
    facts = spark.range(10).repartition(3)

    def joined(most):
        plan = facts.join(broadcast_if_small(rows, most), "id")
        return plan._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in joined(200_000) and "broadcast" not in joined(50_000)


def test_many_constant_filters_are_looked_up(spark):
    rows = spark.range(40).select(
        F.col("id"), F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") != 3, F.col("id").cast("int") % 5).alias("n"), (F.col("id") / 2).alias("x"),
    )
    filters = [f"k = 'k{i}'" for i in range(7)] + [f"(n={i})" for i in range(5)]
    filters += [f"`k`='k{i}' and ( n = {j} )" for i in range(7) for j in range(5)]
    filters += ["x = 3", "k = 'k1' or n = 2", "n = '2'", "upper(k) = 'K1'", "k = 'a and b'", "n = 1 and n = 2", ""]
    filters += [f"id > {i}" for i in range(3)]
    got = sorted(map(tuple, match_filters(rows, filters).select("filter_no", "id").collect()))
    want = sorted(
        (i, r["id"]) for i, f in enumerate(filters) for r in (rows.where(f) if f else rows).select("id").collect()
    )
    assert got == want
    plan = match_filters(rows, filters)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_import_windows_filters_and_null_values(spark, day_facts, tuples):
    source = day_facts(
        [("2020-01-01", 1, 1, 2.0), ("2020-01-01", 1, 1, None), ("2020-01-02", 1, 1, 5.0),
         ("2020-01-03", 1, 1, 7.0, None, 2)]
    )
    runs = [
        Run(11, 5, 2, 1, filter="value1 > 0", fields_source="sum(value1)", fields_target="value3"),
        Run(12, 6, 2, 1, date_from=D(2020, 1, 2), fields_source="sum(value1)", fields_target="value3"),
        Run(13, 7, 2, 2, fields_source="sum(value1)", fields_target="value3"),
    ]
    got = tuples(import_day(source, runs), "import_id", "date", "activity_id", "site_id", "value3")
    assert got == [
        (11, "2020-01-01", 5, 1, 2.0), (11, "2020-01-02", 5, 1, 5.0),
        (12, "2020-01-02", 6, 1, 5.0), (13, "2020-01-03", 7, 2, 7.0),
    ]


def test_import_of_bare_fields_needs_a_choice(spark, day_facts):
    source = day_facts([("2020-01-01", 1, 1, 2.0)])
    with pytest.raises(ValueError, match="SUMFIELDS"):
        import_day(source, [Run(1, 1, 1)])
    summed = import_day(source, [Run(1, 1, 1, flags=flag_set("-SUMFIELDS -NOGROUPBY"))])
    assert summed.first()["value1"] == 2.0


def test_intraday_import_groups_by_interval(spark, tuples):
    source = local_table(
        spark,
        [{"date": D(2024, 1, 1), "interval_id": i, "v": v} for i, v in ((0, 1.0), (0, 2.0), (5, 4.0))],
        "date date, interval_id int, v double",
    )
    runs = [Run(1, 2, 3, fields_source="sum(v)", fields_target="value1")]
    rows = import_intraday(source, runs, durations={1: 30})
    assert tuples(rows, "interval_id", "value1", "duration_min") == [(0, 3.0, 30), (5, 4.0, 30)]


def test_delta_of_an_empty_source_has_no_window(spark, day_facts):
    source = day_facts([("2020-01-05", 1, 1, 1.0)])
    runs = [
        Run(1, 1, 1, filter="value1 > 100"),
        Run(2, 1, 1, date_from=D(2020, 1, 1), date_until=D(2020, 1, 9)),
        Run(3, 1, 1, flags=flag_set("-NODELTA")),
        Run(4, 1, 1, date_until=D(2019, 1, 1), flags=flag_set("-FORCEDELTA")),
    ]
    got = {r["import_id"]: r for r in delta_windows(source, runs).collect()}
    assert not got[1]["has_rows"]
    assert (got[2]["date_from"], got[2]["date_until"]) == (D(2020, 1, 5), D(2020, 1, 5))
    assert (got[3]["date_from"], got[3]["date_until"]) == (D(1900, 1, 1), D(9999, 1, 1))
    assert (got[4]["date_from"], got[4]["date_until"]) == (D(2020, 1, 5), D(2020, 1, 5))


def test_ytd_last_row_is_the_year_sum(spark, day_facts, tuples):
    facts = day_facts(
        days("2019-12-30", [1.0, 2.0, 4.0, None, 8.0]) + [("2020-02-10", 1, 1, 16.0), ("2020-02-11", 1, 1, None, None, 2)]
    )
    runs = [Run(1, 1, 9, p1="1", p2="m"), Run(2, 1, 8, p1="1", p2="week", date_from=D(2019, 12, 31))]
    got = tuples(year_to_date(facts, runs), "import_id", "date", "forecast_id", "value1")
    assert got == [
        (1, "2019-12-31", 9, 3.0), (1, "2020-01-03", 9, 12.0), (1, "2020-02-10", 9, 28.0),
        (2, "2020-01-03", 8, 14.0), (2, "2020-02-10", 8, 30.0),
    ]


def test_ytd_keeps_a_row_a_period_and_not_a_day_in_memory(spark, day_facts, tuples, monkeypatch):
    attach, counts = Reading.attach, []

    def counted(self, rows, extra=None):
        counts.append(rows.count())
        return attach(self, rows, extra)

    monkeypatch.setattr(Reading, "attach", counted)
    facts = day_facts(days("2021-01-01", [1.0] * 365))
    runs = [Run(n, 1, 9, p1="1", p2="month") for n in (1, 2)]
    got = tuples(year_to_date(facts, runs).where("month(date) = 12"), "import_id", "date", "value1")
    assert got == [(1, "2021-12-31", 365.0), (2, "2021-12-31", 365.0)]
    year_to_date(facts, [Run(1, 1, 9, p1="1", p2="week")])
    year_to_date(facts, [Run(1, 1, 9, p1="1", p2="month", date_until=D(2021, 3, 10)), Run(2, 1, 9, p1="1", p2="month", date_from=D(2021, 2, 1))])
    assert counts == [12, 53, 13]


def test_ytd_of_windows_that_cut_periods(spark, day_facts, tuples):
    sold = [(D(2019, 11, 20) + dt.timedelta(n), a, float(n % 11 + a)) for n in range(800) for a in (1, 2) if n % 5 != a]
    facts = day_facts([(str(d), a, 1, v) for d, a, v in sold] + [("2020-05-05", 1, 1, None), ("2020-05-05", 1, 1, 0.5), ("2020-05-06", 1, 2, 9.0)])
    sold.append((D(2020, 5, 5), 1, 0.5))
    windows = [
        (D(1900, 1, 1), D(9999, 1, 1)), (D(2020, 2, 13), D(2021, 1, 3)), (D(2020, 2, 13), dt.date.max), (D(2020, 7, 1), D(2020, 7, 1)),
        (D(2020, 12, 30), D(2021, 1, 6)), (D(2021, 5, 1), D(2020, 5, 1)), (D(1950, 1, 1), D(2020, 6, 17)),
    ]
    runs = [
        Run(10 * n + a + 5 * (level == "week"), a, 9, p1="1", p2=level, date_from=first, date_until=last)
        for n, (first, last) in enumerate(windows) for level in ("week", "month") for a in (1, 2)
    ]
    expected = []
    for r in runs:
        sums, ends = {}, {}
        for d, a, v in sold:
            if a == r.activity_id and r.date_from <= d <= r.date_until:
                period = d.isocalendar()[:2] if r.p2 == "week" else (d.year, d.month)
                sums[period] = sums.get(period, 0.0) + v
                ends[period] = max(d, ends.get(period, d))
        expected += [(r.import_id, str(ends[p]), a, sum(v for q, v in sums.items() if q[0] == p[0] and q <= p)) for p in sums for a in [r.activity_id]]
    assert tuples(year_to_date(facts, runs), "import_id", "date", "activity_id", "value1") == sorted(expected)


def test_parallel_lag_zero_is_the_identity(spark, day_facts, tuples):
    facts = day_facts(days("2020-02-27", [1.0, 2.0, 3.0, 4.0]))
    for level in ("week", "month"):
        rows = parallel_period(facts, [Run(1, 1, 2, p1="1", p2=level, p5="0")])
        assert tuples(rows, "date", "value1") == tuples(facts, "date", "value1")


def test_parallel_skips_days_without_counterpart(spark, day_facts, tuples):
    facts = day_facts([("2020-02-29", 1, 1, 1.0), ("2020-12-31", 1, 1, 2.0), ("2020-03-02", 1, 1, 3.0)])
    month = parallel_period(facts, [Run(1, 1, 2, p1="1", p2="month", p5="1")])
    assert tuples(month, "date", "value1") == [("2021-03-02", 3.0), ("2021-12-31", 2.0)]
    week = parallel_period(facts, [Run(1, 1, 2, p1="1", p2="", p5="1")])
    assert tuples(week, "date", "value1") == [("2021-03-06", 1.0), ("2021-03-08", 3.0)]


def test_parallel_batch_takes_activities_of_a_filter(spark, day_facts, tuples):
    facts = day_facts([("2020-03-02", a, 1, float(a)) for a in (1, 2, 3)])
    activity = local_table(
        spark, [{"activity_id": a, "domain": d} for a, d in ((1, "x"), (2, "y"), (3, "x"))],
        "activity_id int, domain string",
    )
    runs = [Run(1, 1, 2, p1="1", p2="m", p5="1", filter="A.domain='x'"), Run(2, 2, 3, p1="1", p2="m", p5="2")]
    rows = parallel_period(facts, runs, activity)
    assert tuples(rows, "import_id", "activity_id", "date") == [
        (1, 1, "2021-03-02"), (1, 3, "2021-03-02"), (2, 2, "2022-03-02"),
    ]


def test_split_totals_add_up_to_the_month(spark, day_facts):
    facts = day_facts(days("2021-01-01", [float(i % 9 + 1) for i in range(59)]))
    run = Run(
        1, 7, 4, source="310,5 280", filter="activity_id=1 and year=2021", p5="2",
        date_from=D(2022, 1, 1), date_until=D(2022, 12, 31),
    )
    rows = split_totals(facts, [run]).groupBy(F.month("date").alias("m")).agg(F.sum("value1").alias("v"))
    got = dict(rows.collect())
    assert got[1] == pytest.approx(621.0) and got[2] == pytest.approx(560.0) and len(got) == 2


def test_split_of_a_year_by_twelve_totals(spark, day_facts):
    totals = "120167.5 106857 115187 109621 118050 117460 119799 117152 110963 112695 114696 121626"
    facts = day_facts(days("2022-01-01", [float(i % 13 + 2) for i in range(365)], activity=99))
    run = Run(
        1, 50, 2, source=totals, filter="activity_id=99 and forecast_id=1 and year=2022",
        date_from=D(2022, 1, 1), date_until=D(2022, 12, 31),
    )
    rows = split_totals(facts, [run]).groupBy(F.month("date").alias("m")).agg(F.sum("value1").alias("v"))
    got = dict(rows.collect())
    for month, total in enumerate(totals.split(), 1):
        assert got[month] == pytest.approx(float(total))


def test_split_of_a_zero_month_and_feb29(spark, day_facts, tuples):
    facts = day_facts([("2020-01-01", 1, 1, 0.0), ("2020-02-28", 1, 1, 1.0), ("2020-02-29", 1, 1, 3.0)])
    run = Run(1, 7, 4, source="10 20", filter="activity_id=1", date_from=D(2024, 1, 1), date_until=D(2024, 3, 31))
    assert tuples(split_totals(facts, [run]), "date", "value1") == [
        ("2024-01-01", None), ("2024-02-28", 5.0), ("2024-02-29", 15.0),
    ]
    dropped = split_totals(facts, [run], drop_feb29=True)
    assert tuples(dropped, "date", "value1") == [("2024-01-01", None), ("2024-02-28", 20.0)]
    with pytest.raises(ValueError, match="filter"):
        split_totals(facts, [Run(1, 7, 4, source="1")])


def brute_correlation(act, ref, plan, lag):
    def smooth(x):
        keys = sorted(x)
        return {
            t: sum(x[k] for k in keys[max(0, i - 1) : i + 2]) / len(keys[max(0, i - 1) : i + 2])
            for i, t in enumerate(keys)
        }

    def shift(x):
        keys = sorted(x)
        return {t: (x[keys[i - lag]] if i >= lag else None) for i, t in enumerate(keys)}

    a, r, f = smooth(act), shift(smooth(ref)), shift(plan)
    ratio = {t: a[t] / r[t] for t in a if r.get(t)}
    out = {}
    for t, v in f.items():
        found = [(w, ratio[t - k]) for k, w in ((1, 5), (5, 4), (52, 3), (104, 2), (156, 1)) if t - k in ratio]
        if found:
            out[t] = sum(w * (v or 0) * x for w, x in found) / sum(w for w, _ in found)
    return out


def test_correlation_against_brute_force(spark, day_facts):
    first = D(2018, 1, 1)
    act = {t: 10.0 + t % 7 for t in range(170) if t % 11}
    ref = {t: 20.0 + t % 5 for t in range(170)}
    plan = {t: 30.0 + t % 3 for t in range(150, 200) if t != 160}

    def rows(series, activity, forecast):
        return [(str(first + dt.timedelta(days=7 * t + 2)), activity, forecast, v) for t, v in series.items()]

    facts = day_facts(rows(act, 1, 1) + rows(ref, 2, 1) + rows(plan, 2, 3))
    for lag in (0, 2):
        run = Run(1, 1, 5, p1="", parent=" 2", p2="1", p3="3", p4=str(lag), p5="0,5")
        got = {r["date"]: r["value1"] for r in correlation_forecast(facts, [run]).collect()}
        want = brute_correlation(act, ref, plan, lag)
        assert len(got) == 7 * len(want)
        for t, v in want.items():
            for d in range(7):
                assert got[first + dt.timedelta(days=7 * t + d)] == pytest.approx(v / 7 * 0.5)


def test_correlation_needs_driver_and_forecasts(spark, day_facts):
    facts = day_facts([("2020-01-01", 1, 1, 1.0)])
    with pytest.raises(ValueError, match="driver"):
        correlation_forecast(facts, [Run(1, 1, 1, p2="1", p3="2")])
    with pytest.raises(ValueError, match="p2 and p3"):
        correlation_forecast(facts, [Run(1, 1, 1, p1="2", p2="1")])


def parameters(spark, rows):
    letters = "ABCDEFGHIJKLMNOP"
    records = [dict(zip(letters, [str(x) for x in r])) | {"file_id": 417} for r in rows]
    return local_table(spark, records, "file_id int, " + ", ".join(f"{c} string" for c in letters))


def test_regression_by_hand(spark, day_facts):
    values = [float(3 + i % 4) for i in range(40)]
    facts = day_facts(days("2023-01-02", values, forecast=3))
    rows = [["ACT_ID", "n", "set", *["x"] * 9]]
    p = {k: (0.1 * k, 0.5, [0.1, 0.2, 0.0, 0.0, 0.0, -0.3], 1.0) for k in range(5)}
    rows += [[9, "n", f"cat {k}", o, i, *d, f] for k, (o, i, d, f) in p.items()]
    run = Run(
        1, 9, 6, filter="forecast_id=3 and activity_id in (1)", p1="file_id=417",
        fields_source="value1,value2-value3,value8", fields_target="value1,value4,value5",
        date_from=D(2023, 1, 20), date_until=D(2023, 2, 5),
    )
    got = {r["date"]: r for r in regression_lag_categories(facts, parameters(spark, rows), [run]).collect()}
    assert len(got) == 17
    day = D(2023, 1, 25)
    i = (day - D(2023, 1, 2)).days
    lags = [values[i], values[i - 1], values[i - 2], sum(values[i - 6 : i - 2]), sum(values[i - 13 : i - 6])]
    y = []
    for k, c in enumerate(lags):
        o, inc, d, f = p[k]
        y.append(max(0.0, math.exp(o + inc * math.log(c + f) + d[day.weekday()]) - f))
    assert got[day]["value1"] == pytest.approx(sum(y))
    assert got[day]["value4"] == pytest.approx(y[0] - y[1])
    assert got[day]["value5"] == pytest.approx(sum(y[1:]))
    assert got[day]["value2"] is None


def test_regression_clamps_and_counts_missing_lags_as_zero(spark, day_facts):
    facts = day_facts(days("2023-01-02", [1.0, 2.0]))
    rows = [[1, "", k, -5.0, 0.1, 0, 0, 0, 0, 0, 0, 2.0] for k in range(5)]
    run = Run(1, 1, 6, filter="forecast_id=1", parent="1", p1="file_id=417", fields_source="value1,value3", fields_target="value1,value3")
    got = [tuple(r) for r in regression_lag_categories(facts, parameters(spark, rows), [run]).select("value1", "value3").collect()]
    assert got == [(0.0, 0.0), (0.0, 0.0)]
    lone = regression_lag_categories(facts, parameters(spark, rows[1:2]), [run]).orderBy("date")
    assert [r["value3"] for r in lone.collect()] == [None, 0.0]


def test_regression_rejects_repeated_categories(spark, day_facts):
    facts = day_facts(days("2023-01-02", [1.0]))
    rows = [[1, "", 0, *[0] * 9]] * 2
    run = Run(1, 1, 6, filter="forecast_id=1", parent="1", p1="file_id=417")
    with pytest.raises(Exception, match="repeated parameter category"):
        regression_lag_categories(facts, parameters(spark, rows), [run]).collect()


def test_regression_lags_count_rows_or_days(spark, day_facts):
    facts = day_facts([("2023-01-02", 1, 1, 5.0), ("2023-01-04", 1, 1, 1.0)])
    rows = [[1, "", 1, 0, 1, 0, 0, 0, 0, 0, 0, 1.0], [1, "", 2, 0, 1, 0, 0, 0, 0, 0, 0, 1.0]]
    run = Run(1, 1, 6, filter="forecast_id=1", parent="1", p1="file_id=417", fields_source="value3,value4", fields_target="value3,value4")
    sparse = regression_lag_categories(facts, parameters(spark, rows), [run]).where("date='2023-01-04'").first()
    assert (sparse["value3"], sparse["value4"]) == (pytest.approx(5.0), 0.0)
    dense = regression_lag_categories(facts, parameters(spark, rows), [run], dense=True).where("date='2023-01-04'").first()
    assert (dense["value3"], dense["value4"]) == (0.0, pytest.approx(5.0))


def test_simple_regression_is_null_without_history(spark, day_facts):
    values = [float(1 + i % 3) for i in range(16)]
    facts = day_facts(days("2023-01-02", values))
    rows = [[1, "", 0, 0.1, "", 0.2, 0.1, 0.1, 0.1, 0.1, *[0.0] * 6]]
    run = Run(1, 1, 6, filter="forecast_id=1", parent="1", p1="file_id=417", fields_target="value2")
    got = [r["value2"] for r in regression_simple(facts, parameters(spark, rows), [run]).orderBy("date").collect()]
    assert len(got) == 16 and got[:3] == [None] * 3
    lags = [values[15], values[14], values[13], sum(values[9:13]), sum(values[2:9])]
    want = math.exp(0.1 + sum(c * math.log(1 + x) for c, x in zip((0.2, 0.1, 0.1, 0.1, 0.1), lags))) - 1
    assert got[15] == pytest.approx(want)


def test_alert_periods_tests_and_missing_values(spark, day_facts, tuples):
    facts = day_facts(days("2024-01-03", [1.0] * 20) + days("2024-01-01", [2.0] * 22, forecast=2))
    run = dict(filter="forecast_id=1", p2="forecast_id=2", date_from=D(2024, 1, 1), date_until=D(2024, 1, 24))
    blank = alert_series(facts, [Run(1, 1, 9, **run)])
    assert [r[0] for r in tuples(blank, "date")] == ["2024-01-01", "2024-01-02", "2024-01-23", "2024-01-24"]
    week = alert_series(facts, [Run(1, 1, 9, p3="dif_pct > 1", group_by="[year_week]", **run)])
    assert tuples(week, "date", "value1", "value2", "value3") == [("2024-01-01", 5.0, 14.0, 1.8)]
    other = alert_series(facts, [Run(1, 1, 9, p3="value < 10", group_by="year_month", **run)])
    assert other.count() == 0


def test_alert_filter_may_use_the_calendar(spark, day_facts, tuples):
    facts = day_facts(days("2024-01-30", [1.0] * 4))
    run = Run(
        1, 1, 9, filter="forecast_id=1 and T.[month]=2", p3="value > 0", group_by="T.[month]",
        date_from=D(2024, 1, 30), date_until=D(2024, 3, 1),
    )
    got = tuples(alert_series(facts, [run]), "date", "value1")
    assert got == [("2024-02-01", 2.0)]


def test_alert_uses_the_own_activity(spark, day_facts, tuples):
    facts = day_facts([("2024-01-01", a, 1, float(a)) for a in (1, 2)])
    runs = [
        Run(a, a, 9, filter="forecast_id=1", p3="value > 0", date_from=D(2024, 1, 1), date_until=D(2024, 1, 1))
        for a in (1, 2)
    ] + [Run(3, 3, 9, filter="forecast_id=1 and activity_id<9", p3="value > 0", date_from=D(2024, 1, 1), date_until=D(2024, 1, 1))]
    got = tuples(alert_series(facts, runs), "import_id", "value1", "value2")
    assert got == [(1, 1.0, None), (2, 2.0, None), (3, 3.0, None)]


def test_forecast_weeks(spark, tuples):
    dates = local_table(
        spark,
        [{"year52": y, "day_week_set": "1", "week": 10, "year_next_week_fc": 5} for y in (2015, 2016, 2017, 2018)],
        "year52 int, day_week_set string, week int, year_next_week_fc int",
    )
    letters = "ABCDEFGHIJKLMN"
    cells = dict.fromkeys(letters, "") | {"A": "1", "B": "10", "C": "1", "D": "0", "E": " 202533"}
    staged = local_table(spark, [cells], ", ".join(f"{c} string" for c in letters))
    got = assign_forecast_weeks(dates, staged).select("year52", "year_next_week_fc").collect()
    assert sorted(map(tuple, got)) == [(2015, 202510), (2016, None), (2017, 202533), (2018, 5)]


def test_replace_modes_and_counts(spark, day_facts, tuples):
    old = day_facts(days("2024-01-01", [1.0, 2.0, 3.0, 4.0, 5.0]) + days("2024-01-01", [9.0], activity=2))
    new = day_facts([("2024-01-02", 1, 1, 20.0)])
    want = {
        "range": ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"],
        "tail": ["2024-01-01", "2024-01-01", "2024-01-02"],
        "head": ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"],
    }
    for mode, dates in want.items():
        scopes = [Scope(7, 1, 1, D(2024, 1, 2), D(2024, 1, 3), 1, mode)]
        rows = replace_range(old, new, scopes)
        assert [r[0] for r in tuples(rows, "date")] == dates
        assert replaced_counts(old, scopes).first()["rows_deleted"] == 7 - len(dates)
        if mode == "range":
            again = replace_range(rows, new, scopes)
            assert tuples(again, "date", "value1") == tuples(rows, "date", "value1")


@pytest.mark.parametrize("few", [0, 16])
def test_write_back_order_and_nulls(spark, monkeypatch, few):
    monkeypatch.setattr(replace, "FEW_MARKS", few)
    rows = local_table(
        spark,
        [{"date": D(2024, 1, d), "v": d, "import_id": i} for d, i in ((1, None), (2, 99), (3, None))],
        "date date, v int, import_id int",
    )
    runs = [Run(1, 1, 1, filter="v >= 2"), Run(2, 1, 1, flags=flag_set("-SOURCE_UPDATE_NULL"))]
    got = write_back(rows, runs).orderBy("v").select("import_id", "updated_by").collect()
    assert [tuple(r) for r in got] == [(2, 2), (1, 1), (1, 1)]
