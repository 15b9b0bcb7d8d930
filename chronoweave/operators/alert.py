"""Alert series: periods whose value fails a test against a benchmark or is missing."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.calendar import with_calendar
from chronoweave.functions.text import field_list, sql_text
from chronoweave.model import Run, as_fact_day, local_table, union_all
from chronoweave.operators.matching import (
    ANY,
    KEYS,
    Reading,
    Want,
    filterable,
    numbered,
    own_window,
    with_dates,
)


def wants(runs: Sequence[Run]) -> list[Want]:
    """`filter` reads the value and `p2`, if set, the benchmark; a filter that names no
    activity means the own one."""
    out = []
    for r in runs:
        if not r.filter.strip():
            raise ValueError(f"import {r.import_id}: the filter must define a series")
        for role, text in (("value", r.filter), ("benchmark", r.p2)):
            if text.strip():
                own = "activity" not in text.lower()
                out.append(Want(r, filter=text, activity=r.activity_id if own else ANY, role=role))
    return out


def alert_series(
    facts: DataFrame,
    runs: Sequence[Run],
    activity: DataFrame | None = None,
    when: dt.datetime | None = None,
    calendar: tuple[dt.date, dt.date] | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """One row per period that fails: value, benchmark and relative difference in value1..3.

    Periods are the values of `group_by` (default `date`) in the window; weeks and months count
    only when complete. `p3` is the test over `value`, `benchmark` and `dif_pct`; a period
    without a value always alerts, and a blank test alerts on nothing else. Open ends of a
    window are those of `calendar`, without which they are an error. Filters and periods may
    use the attributes of a date table, `dates`; days without a period belong to none.
    """
    runs = [r.closed(calendar) for r in runs]
    shapes: dict[tuple, list[Run]] = defaultdict(list)
    for r in runs:
        value = (field_list(r.fields_source) or ["value1"])[0]
        benchmark = (field_list(r.fields_target) or [value])[0]
        shapes[sql_text(r.group_by) or "date", value, benchmark].append(r)
    return union_all(
        _alerts(facts, group, *shape, activity, when, dates) for shape, group in shapes.items()
    )


def _alerts(facts, runs, period, value, benchmark, activity, when, dates) -> DataFrame:
    spark = facts.sparkSession
    runs = [r for r in runs if r.date_from <= r.date_until]
    if not runs:
        return as_fact_day(facts.where("false"), when)
    reading = Reading(spark, wants(runs))
    rows = reading.rows(reading.in_any_window(filterable(facts, activity, dates)))
    # Per day before imports are attached: the facts are aggregated once per distinct filter.
    per_day = rows.groupBy(*KEYS, "date").agg(
        F.sum(F.expr(value).try_cast("double")).alias("v"),
        F.sum(F.expr(benchmark).try_cast("double")).alias("b"),
    )
    attached = reading.attach(per_day, {"role": ("string", lambda w: w.role)}).where(own_window())
    sums = (
        with_dates(with_calendar(attached), dates)
        .groupBy("import_id", F.expr(period).alias("period"))
        .agg(
            F.sum(F.when(F.col("role") == "value", F.col("v"))).alias("value"),
            F.sum(F.when(F.col("role") == "benchmark", F.col("b"))).alias("benchmark"),
        )
    )
    windows = numbered((r.date_from, r.date_until) for r in runs)
    tests = numbered(sql_text(r.p3) for r in runs)
    targets = local_table(
        spark,
        [
            {
                "window_no": windows[r.date_from, r.date_until],
                "test_no": tests[sql_text(r.p3)],
                "import_id": r.import_id,
                "activity_id": r.activity_id,
                "forecast_id": r.forecast_id,
                "site_id": r.site_id,
            }
            for r in runs
        ],
        "window_no int, test_no int, import_id int, activity_id int, forecast_id int, site_id int",
    )
    periods = complete_periods(spark, list(windows), period, dates).join(targets, "window_no")
    found = periods.join(sums, ["import_id", "period"], "left").withColumn(
        "dif_pct",
        F.when(
            F.col("value") != 0,
            F.abs(F.try_divide(F.col("value") - F.col("benchmark"), F.col("value"))),
        ),
    )
    failed = F.lit(False)
    for test, i in tests.items():
        if test:
            failed = failed | ((F.col("test_no") == i) & F.expr(test))
    alerts = found.where(failed | F.col("value").isNull())
    return as_fact_day(
        alerts.select(
            F.col("date_first").alias("date"),
            "activity_id",
            "forecast_id",
            "import_id",
            "site_id",
            F.col("value").alias("value1"),
            F.col("benchmark").alias("value2"),
            F.col("dif_pct").alias("value3"),
        ),
        when,
    )


def complete_periods(
    spark, windows: Sequence[tuple[dt.date, dt.date]], period: str, dates: DataFrame | None = None
) -> DataFrame:
    """`window_no, period, date_first`: the calendar groups of each window; weeks need 7 days
    and months all their days."""
    table = local_table(
        spark,
        [{"window_no": i, "lo": lo, "hi": hi} for i, (lo, hi) in enumerate(windows)],
        "window_no int, lo date, hi date",
    )
    days = with_calendar(table.select("window_no", F.explode(F.sequence("lo", "hi")).alias("date")))
    days = with_dates(days, dates).where(F.expr(period).isNotNull())
    groups = days.groupBy("window_no", F.expr(period).alias("period")).agg(
        F.min("date").alias("date_first"),
        F.count(F.lit(1)).alias("days"),
        F.min("month_days").alias("month_days"),
    )
    if "month" in period.lower():
        groups = groups.where(F.col("days") == F.col("month_days"))
    elif "week" in period.lower():
        groups = groups.where(F.col("days") == 7)
    return groups.select("window_no", "period", "date_first")
