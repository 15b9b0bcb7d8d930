"""Forecast of a series from a driver series and their weighted historical ratios."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.functions.calendar import WEEK_ZERO, continuous_week
from chronoweave.functions.text import field_list, to_int, to_scale
from chronoweave.model import SERIES, Run, as_fact_day, local_table
from chronoweave.operators.matching import _among, own_window

# Weeks back -> weight of the ratio found there.
RATIO_WEIGHTS = {1: 5.0, 5: 4.0, 52: 3.0, 104: 2.0, 156: 1.0}


def driver_of(run: Run) -> int:
    """The driver activity: `p1`, else the activity's parent."""
    return to_int(run.p1) or to_int(run.parent)


def check(run: Run) -> None:
    if not driver_of(run):
        raise ValueError(f"import {run.import_id}: no driver activity in p1 or as the parent")
    if not to_int(run.p2) or not to_int(run.p3):
        raise ValueError(f"import {run.import_id}: p2 and p3 must name forecasts")


def reach(runs: Sequence[Run]) -> tuple[dt.date, dt.date, int]:
    """First and last day of the weeks whose ratios and forecasts the windows need, and how many weeks with data
    before the first one their smoothing and lags may also look at. One week with data behind the last is enough."""
    first, last = min(r.date_from for r in runs), max(r.date_until for r in runs)
    monday = max(first.toordinal() - first.weekday() - 7 * max(RATIO_WEIGHTS), 1)
    sunday = min(last.toordinal() + 6 - last.weekday(), dt.date.max.toordinal())
    return dt.date.fromordinal(monday), dt.date.fromordinal(sunday), 1 + max(to_int(r.p4) for r in runs)


def correlation_forecast(
    facts: DataFrame, runs: Sequence[Run], when: dt.datetime | None = None
) -> DataFrame:
    """Weekly driver forecast times the weighted mean of past activity/driver ratios, by day.

    Weekly sums of the activity and the driver in forecast `p2` are smoothed over three weeks;
    the driver is moved `p4` weeks with data. Their ratio 1, 5, 52, 104 and 156 weeks back,
    weighted 5..1 over those that exist, scales the driver's weekly sum in forecast `p3`. Each
    day of a week gets a seventh, times `p5`.
    """
    for r in runs:
        check(r)
    spark = facts.sparkSession
    roles = _roles(spark, runs)
    wanted = {(r.site_id, a, f) for r in runs for a, f, _ in reads(r)}
    lags = sorted({to_int(r.p4) for r in runs})
    weekly = weekly_series(
        facts.where(_among("site_id", sorted({s for s, _, _ in wanted})))
        .where(_among("forecast_id", sorted({f for _, _, f in wanted})))
        .where(_among("activity_id", sorted({a for _, a, _ in wanted}))),
        lags,
    )

    def lagged(name: str):
        return F.coalesce(
            *[F.when(F.col("lag") == n, F.col(f"{name}_{i}")) for i, n in enumerate(lags)]
        )

    value = (
        F.when(F.col("role") == "activity", F.col("smooth"))
        .when(F.col("role") == "driver", lagged("smooth"))
        .otherwise(lagged("total"))
    )
    by_role = weekly.join(roles, SERIES).select("import_id", "week_no", "role", value.alias("v"))
    weeks = by_role.groupBy("import_id", "week_no").agg(
        F.max(F.when(F.col("role") == "activity", F.col("v"))).alias("activity"),
        F.max(F.when(F.col("role") == "driver", F.col("v"))).alias("driver"),
        F.max(F.when(F.col("role") == "forecast", F.col("v"))).alias("forecast"),
        F.max(F.col("role") == "forecast").alias("has_forecast"),
    )
    ratio = F.when(F.col("driver") != 0, F.try_divide("activity", "driver"))

    # Each week sends its ratio to the weeks that look back at it, and its forecast to itself:
    # one grouping instead of a join per offset.
    sent = [
        F.struct(
            F.col("week_no").alias("week_no"),
            F.lit(None).cast("double").alias("weighted"),
            F.lit(None).cast("double").alias("weight"),
            F.col("forecast").alias("forecast"),
            F.col("has_forecast").alias("has_forecast"),
        )
    ] + [
        F.struct(
            (F.col("week_no") + back).alias("week_no"),
            (F.col("ratio") * weight).alias("weighted"),
            F.when(F.col("ratio").isNotNull(), F.lit(weight)).alias("weight"),
            F.lit(None).cast("double").alias("forecast"),
            F.lit(False).alias("has_forecast"),
        )
        for back, weight in RATIO_WEIGHTS.items()
    ]
    forecast = (
        weeks.withColumn("ratio", ratio)
        .select("import_id", F.inline(F.array(*sent)))
        .groupBy("import_id", "week_no")
        .agg(
            F.sum("weighted").alias("weighted"),
            F.sum("weight").alias("weight"),
            F.max("forecast").alias("forecast"),
            F.max("has_forecast").alias("has_forecast"),
        )
        .where(F.col("has_forecast") & (F.col("weight") > 0))
        .select(
            "import_id",
            "week_no",
            (F.coalesce("forecast", F.lit(0.0)) * F.col("weighted") / F.col("weight")).alias("f"),
        )
    )
    targets = local_table(
        spark,
        [
            {
                "import_id": r.import_id,
                "activity_id": r.activity_id,
                "forecast_id": r.forecast_id,
                "site_id": r.site_id,
                "date_from": r.date_from,
                "date_until": r.date_until,
                "scale": to_scale(r.p5),
                "target": (field_list(r.fields_target) or ["value1"])[0].strip("`"),
            }
            for r in runs
        ],
        "import_id int, activity_id int, forecast_id int, site_id int, date_from date, "
        "date_until date, scale double, target string",
    )
    monday = F.date_add(F.lit(WEEK_ZERO).cast("date"), F.col("week_no") * 7)
    days = (
        forecast.join(targets, "import_id")
        .withColumn("date", F.explode(F.sequence(monday, F.date_add(monday, 6))))
        .where(own_window())
        .withColumn("value", F.col("f") / 7 * F.col("scale"))
    )
    names = sorted({(field_list(r.fields_target) or ["value1"])[0].strip("`") for r in runs})
    return as_fact_day(
        days.withColumns(
            {n: F.when(F.col("target") == n, F.col("value")) for n in names}
        ),
        when,
    )


def weekly_series(facts: DataFrame, lags: Sequence[int] = ()) -> DataFrame:
    """Per series and continuous week: the `total` of value1, its centred three-week mean
    `smooth`, and both moved by each of `lags` weeks with data, as `total_0, smooth_0, ..`.

    One window pass for all series and lags; a series has at most one row per week.
    """
    weekly = facts.groupBy(*SERIES, continuous_week(F.col("date")).alias("week_no")).agg(
        F.sum(F.coalesce("value1", F.lit(0.0))).alias("total")
    )
    by_week = W.partitionBy(*SERIES).orderBy("week_no")
    smoothed = weekly.withColumn("smooth", F.avg("total").over(by_week.rowsBetween(-1, 1)))
    return smoothed.withColumns(
        {
            f"{name}_{i}": F.lag(name, n).over(by_week) if n else F.col(name)
            for i, n in enumerate(lags)
            for name in ("smooth", "total")
        }
    )


def reads(run: Run) -> list[tuple[int, int, str]]:
    """(activity, forecast, role) of the series that an import reads."""
    return [
        (run.activity_id, to_int(run.p2), "activity"),
        (driver_of(run), to_int(run.p2), "driver"),
        (driver_of(run), to_int(run.p3), "forecast"),
    ]


def _roles(spark, runs: Sequence[Run]) -> DataFrame:
    return local_table(
        spark,
        [
            {
                "import_id": r.import_id,
                "site_id": r.site_id,
                "activity_id": a,
                "forecast_id": f,
                "role": role,
                "lag": to_int(r.p4),
            }
            for r in runs
            for a, f, role in reads(r)
        ],
        "import_id int, site_id int, activity_id int, forecast_id int, role string, lag int",
    )
