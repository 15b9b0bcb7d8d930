"""Derived series: year-to-date, parallel periods, splits, forecasts and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronoweave.functions.calendar import with_calendar
from chronoweave.model import SERIES, Run, local_table
from chronoweave.operators.alert import alert_series
from chronoweave.operators.correlation import RATIO_WEIGHTS, correlation_forecast, weekly_series
from chronoweave.operators.forecast_weeks import FIRST_YEAR, YEAR_COLUMNS, assign_forecast_weeks
from chronoweave.operators.long_series import framed_sums, running_totals
from chronoweave.operators.parallel import parallel_period
from chronoweave.operators.regression import (
    LAG_LAYOUT,
    LAG_ROWS,
    SIMPLE_LAYOUT,
    lag_categories,
    regression_lag_categories,
    regression_simple,
)
from chronoweave.operators.replace import Scope, replace_range
from chronoweave.operators.split import split_totals
from chronoweave.operators.ytd import year_to_date
from chronoweave.plans.changes import change_of, derived_scope, narrowed
from workload.import_queries import imported_orders
from workload.inputs import (
    INTRADAY_FACTS,
    ORDER_FACTS,
    SUPPLIER_ACTIVITY,
    SUPPLIER_FACTS,
    calendar_sql,
    intraday_facts,
    order_facts,
    rounded,
    shown,
    supplier_activity,
    supplier_facts,
    table,
)

D = dt.date
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _region_run(number: int, region: str, **more) -> Run:
    return Run(
        import_id=number,
        activity_id=1,
        forecast_id=20 + number,
        filter=f"A.domain = '{region}'",
        **{"p1": "1", **more},
    )


def q_ytd_of_import(spark, sf):
    """Orders imported per priority, then their year-to-date per month."""
    runs = [Run(700 + n, n, 25, p1="1", p2="month") for n in range(1, 6)]
    return shown(year_to_date(imported_orders(spark, sf), runs), "value1", "value2")


def _ytd_sql(facts: str, period: str, season: str, source: str) -> str:
    return f"""WITH {facts}, cal AS (SELECT *, {period} AS period, {season} AS season FROM ({source}) z),
p AS (SELECT import_id, forecast_id, activity_id, season, period, max(date) AS date,
             sum(value1) AS value1, sum(value2) AS value2
      FROM cal GROUP BY ALL),
r AS (SELECT date, activity_id, forecast_id, 1 AS site_id, import_id,
        sum(value1) OVER w AS value1, sum(value2) OVER w AS value2
      FROM p WINDOW w AS (PARTITION BY import_id, activity_id, season ORDER BY date ROWS UNBOUNDED PRECEDING))
SELECT date, activity_id, forecast_id, site_id, import_id, {rounded('value1', 'value2')} FROM r"""


SQL_YTD_OF_IMPORT = _ytd_sql(
    ORDER_FACTS, "month(date)", "year(date)",
    "SELECT date, activity_id, 25 AS forecast_id, 700 + activity_id AS import_id, value1, value2 FROM order_facts",
)

_REGION_VALUES = ", ".join(f"({i}, '{r}')" for i, r in enumerate(REGIONS, 1))
_REGION_FACTS = f"{SUPPLIER_FACTS}, {SUPPLIER_ACTIVITY}, regions(number, name) AS (VALUES {_REGION_VALUES})"
_REGION_JOIN = "supplier_facts f JOIN supplier_activity a ON f.activity_id = a.activity_id JOIN regions ON domain = name"


def q_ytd_month(spark, sf):
    """Every supplier's year-to-date per month: one import per region covers its suppliers."""
    runs = [_region_run(i, r, p2="month") for i, r in enumerate(REGIONS, 1)]
    return shown(
        year_to_date(supplier_facts(spark, sf), runs, supplier_activity(spark, sf)), "value1", "value2"
    )


SQL_YTD_MONTH = _ytd_sql(
    _REGION_FACTS, "month(date)", "year(date)",
    f"SELECT date, f.activity_id, 20 + number AS forecast_id, number AS import_id, value1, value2 FROM {_REGION_JOIN}",
)


CHANGED_FROM, CHANGED_UNTIL = D(1998, 11, 20), D(1999, 1, 10)


def _changed_facts(spark, sf):
    """Supplier facts, those facts after some days of some suppliers were replaced, and the scopes of it."""
    old = supplier_facts(spark, sf)
    new = old.where(F.col("date").between(F.lit(CHANGED_FROM), F.lit(CHANGED_UNTIL)) & (F.col("activity_id") % 7 == 3))
    new = new.where("value3 > 1").withColumns({"value1": F.col("value1") * 3, "value2": F.col("value2") + 1000})
    scopes = [Scope(90, 1, 1, CHANGED_FROM, CHANGED_UNTIL, filter="activity_id % 7 = 3")]
    return old, replace_range(old, new, scopes), [change_of(s) for s in scopes]


CHANGED_FACTS = SUPPLIER_FACTS.replace("supplier_facts AS", "shipped AS") + f""", touched AS (
  SELECT *, date BETWEEN DATE '{CHANGED_FROM}' AND DATE '{CHANGED_UNTIL}' AND activity_id % 7 = 3 AS t FROM shipped),
supplier_facts AS (
  SELECT date, activity_id, forecast_id, site_id, import_id, CASE WHEN t THEN value1 * 3 ELSE value1 END AS value1,
         CASE WHEN t THEN value2 + 1000 ELSE value2 END AS value2, value3
  FROM touched WHERE NOT t OR value3 > 1)"""


def _followed(operator: str, derive, facts, changed, changes, runs, activity):
    """Series derived before a change, brought up to date for the days that it reaches alone."""
    concerned = [n for r in runs if (n := narrowed(operator, r, changes))]
    reached = F.col("date").between(F.lit(min(r.date_from for r in concerned)), F.lit(max(r.date_until for r in concerned)))
    again = derive(changed.where(reached), concerned, activity)
    return replace_range(derive(facts, runs, activity), again, [derived_scope(operator, r) for r in concerned], activity)


def q_ytd_after_change(spark, sf):
    """Year-to-date by month, of which a change of some weeks renews two years."""
    runs = [_region_run(i, r, p2="month") for i, r in enumerate(REGIONS, 1)]
    facts, changed, changes = _changed_facts(spark, sf)
    return shown(_followed("ytd", year_to_date, facts, changed, changes, runs, supplier_activity(spark, sf)), "value1", "value2")


SQL_YTD_AFTER_CHANGE = _ytd_sql(
    f"{CHANGED_FACTS}, {SUPPLIER_ACTIVITY}, regions(number, name) AS (VALUES {_REGION_VALUES})", "month(date)", "year(date)",
    f"SELECT date, f.activity_id, 20 + number AS forecast_id, number AS import_id, value1, value2 FROM {_REGION_JOIN}",
)


def q_ytd_week(spark, sf):
    """As by month but by ISO week, from the middle of a year on."""
    runs = [
        _region_run(i, r, p2="week", date_from=D(1996, 5, 15), date_until=D(2001, 3, 31))
        for i, r in enumerate(REGIONS, 1)
    ]
    return shown(
        year_to_date(supplier_facts(spark, sf), runs, supplier_activity(spark, sf)), "value1", "value2"
    )


SQL_YTD_WEEK = _ytd_sql(
    _REGION_FACTS, "weekofyear(date)", "isoyear(date)",
    "SELECT date, f.activity_id, 20 + number AS forecast_id, number AS import_id, value1, value2 "
    f"FROM {_REGION_JOIN} WHERE date BETWEEN DATE '1996-05-15' AND DATE '2001-03-31'",
)


def _parallel(level: str, fields: dict):
    def query(spark, sf):
        runs = [
            _region_run(i, r, p2=level, p5=str(1 + i % 3), date_from=D(1997, 1, 1), date_until=D(2003, 12, 31), **fields)
            for i, r in enumerate(REGIONS, 1)
        ]
        rows = parallel_period(supplier_facts(spark, sf), runs, supplier_activity(spark, sf))
        return shown(rows, "value1", "value2")

    return query


def _parallel_sql(keys: str, year: str, v1: str, v2: str) -> str:
    """Joined to the calendar, as the alignment is defined; the operator computes the date."""
    return f"""WITH {_REGION_FACTS},
days AS (SELECT date, {calendar_sql('date')} FROM (
  SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2004-12-31', INTERVAL 1 DAY)) AS DATE) AS date) g),
src AS (SELECT d.*, f.activity_id, number, value1, value2
        FROM {_REGION_JOIN} JOIN days d ON d.date = f.date)
SELECT t.date, activity_id, 20 + number AS forecast_id, 1 AS site_id, number AS import_id,
       round({v1}, 4) AS value1, round({v2}, 4) AS value2
FROM src s JOIN days t ON {keys} AND s.{year} = t.{year} - (1 + number % 3)
WHERE t.date BETWEEN DATE '1997-01-01' AND DATE '2003-12-31'"""


SQL_PARALLEL_WEEK = _parallel_sql("s.day_week = t.day_week AND s.week = t.week", "year52", "value1", "value2")
SQL_PARALLEL_MONTH = _parallel_sql(
    "s.day_month = t.day_month AND s.month = t.month", "year", "value1 + value2", "value1 * 0.5"
)

SPLIT_TOTALS = [1000.5 + 25 * i for i in range(84)]


def q_split_totals(spark, sf):
    """Planned monthly totals over the whole profile of each priority, laid on two years."""
    text = " ".join(str(t).replace(".", ",") for t in SPLIT_TOTALS)
    runs = [
        Run(
            import_id=800 + n,
            activity_id=10 + n,
            forecast_id=4,
            source=text,
            filter=f"F.activity_id={n} and forecast_id=1 and year < 2100",
            p5="1,5" if n == 2 else "",
            fields_source="value1,value1",
            fields_target="value1,value2",
            date_from=D(2003, 1, 1),
            date_until=D(2004, 12, 31),
        )
        for n in range(1, 6)
    ]
    profile = order_facts(spark, sf).withColumn("value1", F.col("value2"))
    return shown(split_totals(profile, runs), "value1", "value2")


SQL_SPLIT_TOTALS = f"""WITH {ORDER_FACTS},
totals(month_no, total) AS (VALUES {", ".join(f"({i}, CAST({t} AS DOUBLE))" for i, t in enumerate(SPLIT_TOTALS, 1))}),
w AS (SELECT activity_id, dayofyear(date) AS day_year,
        value2 / nullif(sum(value2) OVER (PARTITION BY activity_id, strftime(date, '%Y%m')), 0) AS weight,
        dense_rank() OVER (PARTITION BY activity_id ORDER BY strftime(date, '%Y%m')) AS month_no
      FROM order_facts),
days AS (SELECT CAST(unnest(generate_series(DATE '2003-01-01', DATE '2004-12-31', INTERVAL 1 DAY)) AS DATE) AS date),
r AS (SELECT days.date, activity_id AS n, weight * total * CASE WHEN activity_id = 2 THEN 1.5 ELSE 1 END AS v
      FROM w JOIN totals t ON t.month_no = w.month_no JOIN days ON dayofyear(days.date) = day_year)
SELECT date, 10 + n AS activity_id, 4 AS forecast_id, 1 AS site_id, 800 + n AS import_id,
       round(v, 4) AS value1, round(v, 4) AS value2 FROM r"""


def facts_with_forecast(spark, sf):
    """Order facts plus a forecast 2 that scales them by the activity."""
    facts = order_facts(spark, sf)
    plan = facts.withColumns(
        {"forecast_id": F.lit(2), "value1": F.col("value1") * (1 + F.col("activity_id") / 10)}
    )
    return facts.unionByName(plan)


def q_correlation_forecast(spark, sf):
    """Each priority forecast from the next one's plan."""
    runs = [
        Run(
            import_id=850 + n,
            activity_id=n,
            forecast_id=5,
            p1=str(n % 5 + 1) if n != 3 else "",
            parent="4" if n == 3 else "",
            p2="1",
            p3="2",
            p4=str(n - 1),
            p5="1.5" if n == 1 else "",
            date_from=D(1996, 1, 1),
            date_until=D(2002, 12, 31),
        )
        for n in range(1, 6)
    ]
    return shown(correlation_forecast(facts_with_forecast(spark, sf), runs), "value1")


_OFFSETS = ", ".join(f"({k}, CAST({w} AS DOUBLE))" for k, w in RATIO_WEIGHTS.items())
SQL_CORRELATION_FORECAST = f"""WITH {ORDER_FACTS},
runs(n, driver, lag) AS (VALUES (1, 2, 0), (2, 3, 1), (3, 4, 2), (4, 5, 3), (5, 1, 4)),
offsets(k, w) AS (VALUES {_OFFSETS}),
weeks AS (SELECT activity_id, CAST(floor(date_diff('day', DATE '2000-01-03', date) / 7.0) AS INTEGER) AS t,
                 sum(coalesce(value1, 0)) AS v FROM order_facts GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER s AS rn,
               avg(v) OVER (PARTITION BY activity_id ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth
             FROM weeks WINDOW s AS (PARTITION BY activity_id ORDER BY t)),
act AS (SELECT n, t, smooth FROM runs JOIN numbered ON activity_id = n),
ref AS (SELECT n, a.t, b.smooth, b.v * (1 + driver / 10.0) AS plan FROM runs
        JOIN numbered a ON a.activity_id = driver
        LEFT JOIN numbered b ON b.activity_id = driver AND b.rn = a.rn - lag),
ratio AS (SELECT act.n, act.t, act.smooth / ref.smooth AS r FROM act JOIN ref ON act.n = ref.n AND act.t = ref.t
          WHERE coalesce(ref.smooth, 0) <> 0),
f AS (SELECT ref.n, ref.t, sum(w * coalesce(plan * r, 0)) / sum(w) AS f
      FROM ref CROSS JOIN offsets JOIN ratio ON ratio.n = ref.n AND ratio.t = ref.t - k
      GROUP BY ref.n, ref.t),
days AS (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
SELECT date, n AS activity_id, 5 AS forecast_id, 1 AS site_id, 850 + n AS import_id,
       round(f / 7 * CASE WHEN n = 1 THEN 1.5 ELSE 1 END, 4) AS value1
FROM f JOIN days ON CAST(floor(date_diff('day', DATE '2000-01-03', date) / 7.0) AS INTEGER) = t"""

# Coefficients per lag category: offset, inc, d1..d6, f.
LAG_COEFFICIENTS = {
    c: [0.2 - 0.05 * c, 0.4 + 0.03 * c, 0.1, 0.05, -0.02, 0.0, 0.03, -0.4, 1.0 + (c == 3)]
    for c in range(5)
}
SIMPLE_COEFFICIENTS = [0.1, 0.3, 0.1, 0.05, 0.04, 0.03, 0.1, 0.05, -0.02, 0.0, 0.03, -0.4]


def _staged_parameters(spark, layout, rows: list[tuple[int, str, list[float]]], file_id: int):
    letters = "ABCDEFGHIJKLMNOP"
    records = [
        {"file_id": file_id, "A": "ACT_ID", "C": "Parameterset", **{c: "text" for c in layout.values()}}
    ] + [
        {"file_id": file_id, "A": str(a), "C": c, **{col: str(v) for col, v in zip(layout.values(), values)}}
        for a, c, values in rows
    ]
    return local_table(spark, records, "file_id int, " + ", ".join(f"{c} string" for c in letters))


def lag_parameter_file(spark):
    rows = [(n, f"lag {c}", LAG_COEFFICIENTS[c]) for n in range(1, 6) for c in range(5) if (n, c) != (5, 2)]
    return _staged_parameters(spark, LAG_LAYOUT, rows, 417)


def simple_parameter_file(spark):
    return _staged_parameters(
        spark, SIMPLE_LAYOUT, [(n, "set 0", SIMPLE_COEFFICIENTS) for n in range(1, 6)], 418
    )


def _regression_runs(file_id: int, base: int, **more) -> list[Run]:
    return [
        Run(
            import_id=base + n,
            activity_id=n,
            forecast_id=6,
            filter="forecast_id=1" if n > 1 else "forecast_id=1 and activity_id in (1, 5)",
            parent=str(n),
            p1=f"file_id={file_id}",
            date_from=D(1995, 1, 5),
            date_until=D(2001, 12, 31),
            **more,
        )
        for n in range(1, 6)
    ]


def q_regression_lag_categories(spark, sf):
    """One equation per lag category and priority over all order days."""
    runs = _regression_runs(
        417, 860,
        fields_source="value1,value2,value3,value4,value5,value6,value1-value2,value8",
        fields_target="value1,value2,value3,value4,value5,value6,value7,value8",
    )
    rows = regression_lag_categories(order_facts(spark, sf), lag_parameter_file(spark), runs)
    return shown(rows, *[f"value{i}" for i in range(1, 9)])


_LAG_SQL = f"""{ORDER_FACTS},
d AS (SELECT n, date, sum(value1) AS v FROM order_facts
      JOIN (VALUES (1), (2), (3), (4), (5)) r(n) ON activity_id = n OR (n = 1 AND activity_id = 5)
      WHERE date BETWEEN DATE '1995-01-05' - INTERVAL 30 DAY AND DATE '2001-12-31' GROUP BY 1, 2),
lags AS (SELECT n, date, isodow(date) AS dw, v AS c0,
    sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS c1,
    sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 2 PRECEDING AND 2 PRECEDING) AS c2,
    sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 6 PRECEDING AND 3 PRECEDING) AS c3,
    sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS c4
  FROM d)"""


def _effect(values: list[float]) -> str:
    return "CASE dw " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values, 1)) + " ELSE 0 END"


def _category_sql(c: int) -> str:
    offset, inc, *days, f = LAG_COEFFICIENTS[c]
    x = f"(c{c} + {f})"
    y = f"exp({offset} + {inc} * CASE WHEN {x} > 0 THEN ln({x}) END + {_effect(days)}) - {f}"
    known = "n <> 5" if c == 2 else "true"
    return f"greatest(coalesce(CASE WHEN {known} THEN {y} END, 0), 0) AS y{c}"


SQL_REGRESSION_LAG_CATEGORIES = f"""WITH {_LAG_SQL},
y AS (SELECT n, date, {", ".join(_category_sql(c) for c in range(5))} FROM lags WHERE date >= DATE '1995-01-05')
SELECT date, n AS activity_id, 6 AS forecast_id, 1 AS site_id, 860 + n AS import_id,
       round(y0 + y1 + y2 + y3 + y4, 4) AS value1, round(y0, 4) AS value2, round(y1, 4) AS value3,
       round(y2, 4) AS value4, round(y3, 4) AS value5, round(y4, 4) AS value6,
       round(y1 + y2 + y3 + y4, 4) AS value7, round(y1 + y2 + y3 + y4, 4) AS value8
FROM y"""


def q_regression_simple(spark, sf):
    rows = regression_simple(
        order_facts(spark, sf), simple_parameter_file(spark), _regression_runs(418, 870, fields_target="value3")
    )
    return shown(rows, "value3")


_S = SIMPLE_COEFFICIENTS
SQL_REGRESSION_SIMPLE = f"""WITH {_LAG_SQL}
SELECT date, n AS activity_id, 6 AS forecast_id, 1 AS site_id, 870 + n AS import_id,
  round(exp({_S[0]} + {" + ".join(f"{_S[1 + c]} * ln(1 + c{c})" for c in range(5))} + {_effect(_S[6:])}) - 1, 4) AS value3
FROM lags WHERE date >= DATE '1995-01-05'"""


def q_lag_categories(spark, sf):
    """Lagged sums of every supplier's daily quantity, counted in rows with data."""
    facts = supplier_facts(spark, sf).withColumn("import_id", F.col("activity_id"))
    rows = lag_categories(facts.select("import_id", "date", "value1"))
    return rows.select("import_id", "date", *[F.round(f"c{k}", 4).alias(f"c{k}") for k in range(5)])


SQL_LAG_CATEGORIES = f"""WITH {SUPPLIER_FACTS}, f AS (SELECT activity_id AS n, date, value1 AS v FROM supplier_facts)
SELECT n AS import_id, date, round(v, 4) AS c0,
  round(sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING), 4) AS c1,
  round(sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 2 PRECEDING AND 2 PRECEDING), 4) AS c2,
  round(sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 6 PRECEDING AND 3 PRECEDING), 4) AS c3,
  round(sum(v) OVER (PARTITION BY n ORDER BY date ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 4) AS c4
FROM f"""

def q_weekly_series(spark, sf):
    """Every supplier's weekly quantity, smoothed and moved by one and four weeks."""
    rows = weekly_series(supplier_facts(spark, sf), [1, 4])
    return rows.select(
        "activity_id", "week_no", *[F.round(c, 4).alias(c) for c in ("total", "smooth", "smooth_0", "total_1")]
    )


SQL_WEEKLY_SERIES = f"""WITH {SUPPLIER_FACTS},
w AS (SELECT activity_id, CAST(floor(date_diff('day', DATE '2000-01-03', date) / 7.0) AS INTEGER) AS week_no,
             sum(value1) AS total FROM supplier_facts GROUP BY 1, 2),
s AS (SELECT *, avg(total) OVER (PARTITION BY activity_id ORDER BY week_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth FROM w)
SELECT activity_id, week_no, round(total, 4) AS total, round(smooth, 4) AS smooth,
  round(lag(smooth, 1) OVER (PARTITION BY activity_id ORDER BY week_no), 4) AS smooth_0,
  round(lag(total, 4) OVER (PARTITION BY activity_id ORDER BY week_no), 4) AS total_1
FROM s"""

ALERT_FROM, ALERT_UNTIL = D(1994, 12, 20), D(2001, 8, 15)


def _alert_runs(period: str, test: str, base: int) -> list[Run]:
    """Shipped value of a region against that of the next one."""
    return [
        Run(
            import_id=base + i,
            activity_id=900 + i,
            forecast_id=9,
            filter=f"A.domain='{r}' and DATA.activity_id > 0",
            p2=f"activity_id > 0 and domain='{REGIONS[i % 5]}'" if i != 5 else "",
            p3=test,
            group_by=period,
            fields_source="value2",
            fields_target="value2 * 1.1",
            date_from=ALERT_FROM,
            date_until=ALERT_UNTIL,
        )
        for i, r in enumerate(REGIONS, 1)
    ]


def _alert(period: str, test: str, base: int):
    def query(spark, sf):
        rows = alert_series(
            supplier_facts(spark, sf), _alert_runs(period, test, base), supplier_activity(spark, sf)
        )
        return shown(rows, "value1", "value2", "value3")

    return query


def _alert_sql(period: str, test: str, base: int, having: str) -> str:
    return f"""WITH {_REGION_FACTS},
days AS (SELECT date, {calendar_sql('date')} FROM (
  SELECT CAST(unnest(generate_series(DATE '{ALERT_FROM}', DATE '{ALERT_UNTIL}', INTERVAL 1 DAY)) AS DATE) AS date) g),
sums AS (SELECT number, d.{period} AS period, sum(value2) AS s, sum(value2 * 1.1) AS b
         FROM {_REGION_JOIN} JOIN days d ON d.date = f.date GROUP BY 1, 2),
periods AS (SELECT {period} AS period, min(date) AS date_first FROM days GROUP BY {period} {having}),
c AS (SELECT date_first AS date, r.number, v.s AS value, w.b AS benchmark,
        CASE WHEN v.s <> 0 AND w.b IS NOT NULL THEN abs((v.s - w.b) / v.s) END AS dif_pct
      FROM periods p CROSS JOIN regions r
      LEFT JOIN sums v ON v.number = r.number AND v.period = p.period
      LEFT JOIN sums w ON w.number = r.number % 5 + 1 AND w.period = p.period AND r.number <> 5)
SELECT date, 900 + number AS activity_id, 9 AS forecast_id, 1 AS site_id, {base} + number AS import_id,
       round(value, 4) AS value1, round(benchmark, 4) AS value2, round(dif_pct, 4) AS value3
FROM c WHERE {test} OR value IS NULL"""


def q_alert_after_change(spark, sf):
    """Monthly alerts, of which a change of some weeks renews three months."""
    facts, changed, changes = _changed_facts(spark, sf)
    runs = _alert_runs("year_month", "dif_pct > 0.05", 1020)
    rows = _followed("alert", alert_series, facts, changed, changes, runs, supplier_activity(spark, sf))
    return shown(rows, "value1", "value2", "value3")


_ALERTS = {
    "alert_day": ("date", "dif_pct > 0.5", 1000, ""),
    "alert_week": ("year_week", "dif_pct > 0.2 or value < 100000", 1010, "HAVING count(*) = 7"),
    "alert_month": ("year_month", "dif_pct > 0.05", 1020, "HAVING count(*) = min(month_days)"),
    "alert_quarter": ("year_quarter", "benchmark > value", 1030, ""),
}


def order_weeks(spark, sf):
    """Order days twenty years on, as a date table whose weekday is the weekday set."""
    days = table(spark, sf, "orders").select(
        F.add_months(F.col("o_orderdate").cast("date"), 240).alias("date")
    )
    counted = days.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    return with_calendar(counted).withColumns(
        {
            "day_week_set": F.col("day_week").cast("string"),
            "year_next_week_fc": F.when(F.col("orders") > 5, F.col("year_week")),
        }
    )


def q_forecast_week_assign(spark, sf):
    """A staged grid of weekday sets and weeks by year, taken from order counts, assigned to
    the date table."""
    dates = order_weeks(spark, sf)
    cells = {
        letter: F.max(F.when(F.col("year52") == FIRST_YEAR + i, (F.col("orders") % 4).cast("string")))
        for i, letter in enumerate(YEAR_COLUMNS)
    }
    staged = dates.groupBy(
        F.col("day_week_set").alias("A"), F.col("week").cast("string").alias("B")
    ).agg(*[F.coalesce(c, F.lit("")).alias(n) for n, c in cells.items()])
    return assign_forecast_weeks(dates, staged).select("date", "orders", "day_week_set", "year_next_week_fc")


SQL_FORECAST_WEEK_ASSIGN = """WITH d AS (
  SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 20 YEAR AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1),
c AS (SELECT date, orders, CAST(isodow(date) AS VARCHAR) AS day_week_set, CAST(weekofyear(date) AS INTEGER) AS week,
        CAST(isoyear(date) AS INTEGER) AS year52 FROM d),
g AS (SELECT day_week_set, week, year52, max(orders % 4) AS cell FROM c
      WHERE year52 BETWEEN 2015 AND 2026 GROUP BY ALL)
SELECT date, orders, c.day_week_set,
  CAST(CASE WHEN g.cell IS NULL THEN CASE WHEN orders > 5 THEN c.year52 * 100 + c.week END
       WHEN g.cell = 1 THEN 202500 + c.week WHEN g.cell = 0 THEN NULL ELSE g.cell END AS INTEGER) AS year_next_week_fc
FROM c LEFT JOIN g ON c.day_week_set = g.day_week_set AND c.week = g.week AND c.year52 = g.year52"""

def q_intraday_running_totals(spark, sf):
    """Totals so far of every event type by quarter hour: blocks of days, no task with a whole series."""
    facts = intraday_facts(spark, sf)
    found = running_totals(facts, SERIES, ["date", "interval_id"], F.col("date"), {"events": "value1", "total": "value2"})
    return found.select("date", "interval_id", "activity_id", F.col("events").cast("bigint").alias("events"), F.round("total", 2).alias("total"))


SQL_INTRADAY_RUNNING_TOTALS = f"""WITH {INTRADAY_FACTS}
SELECT date, interval_id, activity_id, CAST(sum(value1) OVER w AS BIGINT) AS events, round(sum(value2) OVER w, 2) AS total
FROM intraday_facts WINDOW w AS (PARTITION BY activity_id ORDER BY date, interval_id)"""


def q_intraday_lag_sums(spark, sf):
    """Lag categories of every event type over quarter hours with data, in chunks of 500 rows and their halo."""
    facts = intraday_facts(spark, sf).select(*SERIES, "date", "interval_id", "value1")
    frames = {f"c{k}": ("value1", *rows) for k, rows in LAG_ROWS.items()} | {"around": ("value1", -4, 4)}
    found = framed_sums(facts, SERIES, ["date", "interval_id"], F.col("date"), frames, size=500)
    return found.select("date", "interval_id", "activity_id", *frames)


SQL_INTRADAY_LAG_SUMS = f"""WITH {INTRADAY_FACTS}
SELECT date, interval_id, activity_id, sum(value1) OVER (w ROWS BETWEEN CURRENT ROW AND CURRENT ROW) AS c0,
       lag(value1, 1) OVER w AS c1, lag(value1, 2) OVER w AS c2, sum(value1) OVER (w ROWS BETWEEN 6 PRECEDING AND 3 PRECEDING) AS c3,
       sum(value1) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS c4, sum(value1) OVER (w ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS around
FROM intraday_facts WINDOW w AS (PARTITION BY activity_id ORDER BY date, interval_id)"""

QUERIES = {
    "intraday_running_totals": q_intraday_running_totals,
    "intraday_lag_sums": q_intraday_lag_sums,
    "ytd_of_import": q_ytd_of_import,
    "ytd_month": q_ytd_month,
    "ytd_week": q_ytd_week,
    "parallel_week": _parallel("week", {}),
    "parallel_month": _parallel(
        "month", {"fields_source": "value1 + value2, value1 * 0.5", "fields_target": "value1,value2"}
    ),
    "split_totals": q_split_totals,
    "correlation_forecast": q_correlation_forecast,
    "regression_lag_categories": q_regression_lag_categories,
    "regression_simple": q_regression_simple,
    "lag_categories": q_lag_categories,
    "weekly_series": q_weekly_series,
    **{name: _alert(*spec[:3]) for name, spec in _ALERTS.items()},
    "ytd_after_change": q_ytd_after_change,
    "alert_after_change": q_alert_after_change,
    "forecast_week_assign": q_forecast_week_assign,
}
ORACLE = {
    "intraday_running_totals": SQL_INTRADAY_RUNNING_TOTALS,
    "intraday_lag_sums": SQL_INTRADAY_LAG_SUMS,
    "ytd_of_import": SQL_YTD_OF_IMPORT,
    "ytd_month": SQL_YTD_MONTH,
    "ytd_week": SQL_YTD_WEEK,
    "parallel_week": SQL_PARALLEL_WEEK,
    "parallel_month": SQL_PARALLEL_MONTH,
    "split_totals": SQL_SPLIT_TOTALS,
    "correlation_forecast": SQL_CORRELATION_FORECAST,
    "regression_lag_categories": SQL_REGRESSION_LAG_CATEGORIES,
    "regression_simple": SQL_REGRESSION_SIMPLE,
    "lag_categories": SQL_LAG_CATEGORIES,
    "weekly_series": SQL_WEEKLY_SERIES,
    **{name: _alert_sql(*spec) for name, spec in _ALERTS.items()},
    "ytd_after_change": SQL_YTD_AFTER_CHANGE,
    "alert_after_change": _alert_sql(*_ALERTS["alert_month"]).replace(SUPPLIER_FACTS, CHANGED_FACTS),
    "forecast_week_assign": SQL_FORECAST_WEEK_ASSIGN,
}
