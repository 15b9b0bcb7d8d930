"""Reporting views over the facts, and the view of a job scheduler's history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.calendar import calendar_columns
from chronoweave.model import VALUES, broadcast_if_small

_DATE_COLUMNS = {
    "YYYY": "year",
    "YYYYMM": "year_month_char",
    "YYYYWww": "year_week_short",
    "week": "week",
    "month": "month",
    "day_week": "day_week",
}


def fact_day_view(
    facts: DataFrame, activity: DataFrame, forecast: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Day facts with activity and forecast names and calendar attributes.

    Facts without their activity or forecast drop out; with a `dates` table also those on other
    days. Without it the attributes come from the date itself, which saves the join.
    """
    return _view(facts, activity, forecast, dates, [])


def fact_intraday_view(
    facts: DataFrame,
    activity: DataFrame,
    forecast: DataFrame,
    intervals: DataFrame,
    dates: DataFrame | None = None,
) -> DataFrame:
    """As `fact_day_view` for 15-minute facts, with the interval's start time."""
    starts = intervals.select(F.col("interval_id").cast("smallint"), "time_start")
    timed = facts.join(broadcast_if_small(starts), "interval_id")
    return _view(timed, activity, forecast, dates, ["time_start"])


def _view(facts, activity, forecast, dates, more) -> DataFrame:
    names = activity.select(
        "activity_id", "activity_name", "activity_set", "domain", "region",
        "slicer1", "slicer2", "slicer3",
    )
    scenarios = forecast.select("forecast_id", "forecast_name")
    named = facts.join(broadcast_if_small(names), "activity_id").join(
        broadcast_if_small(scenarios), "forecast_id"
    )
    if dates is not None:
        days = dates.select("date", *_DATE_COLUMNS.values())
        named = named.join(broadcast_if_small(days), "date")
        attributes = {out: F.col(name) for out, name in _DATE_COLUMNS.items()}
    else:
        cal = calendar_columns(F.col("date"))
        attributes = {out: cal[name] for out, name in _DATE_COLUMNS.items()}
    return named.select(
        F.col("date").alias("date_view"),
        "activity_id",
        "forecast_id",
        *VALUES,
        "activity_name",
        "forecast_name",
        "activity_set",
        "domain",
        "region",
        *[c.alias(out) for out, c in attributes.items()],
        "site_id",
        "slicer1",
        "slicer2",
        "slicer3",
        *more,
    )


def labelled_values(facts: DataFrame, activity: DataFrame, template: DataFrame) -> DataFrame:
    """Facts in long form: one row per value that the activity's template names."""
    titles = template.select(
        "template_id",
        *[F.col(v).alias(f"{v}_name") for v in VALUES],
        *[f"{v}_description" for v in VALUES],
    )
    titled = activity.select("activity_id", "template_id").join(titles, "template_id")
    joined = facts.join(broadcast_if_small(titled), "activity_id")
    entries = F.array(
        *[
            F.struct(
                F.col(f"{v}_name").alias("value_name"),
                F.col(f"{v}_description").alias("value_description"),
                F.col(v).alias("value"),
            )
            for v in VALUES
        ]
    )
    return joined.select("date", "site_id", "activity_id", "forecast_id", F.inline(entries)).where(
        F.col("value_name").isNotNull()
    )


# Run status codes.
RUN_STATUS = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Canceled", 4: "In Progress"}


def job_history_view(
    jobs: DataFrame,
    history: DataFrame,
    steps: DataFrame,
    now: dt.datetime | None = None,
    job_name: str | None = None,
) -> DataFrame:
    """Job runs with status text, `hh:mm:ss` duration, seconds and seconds since the start.

    `run_date` is yyyymmdd, `run_time` and `run_duration` are hhmmss, all as integers. Times are
    the scheduler's wall clock, without a zone, and so is `now`.
    """
    if job_name is not None:
        jobs = jobs.where(F.col("name") == job_name)
    names = broadcast_if_small(jobs.select("job_id", "name"))
    titles = broadcast_if_small(steps.select("job_id", "step_id", "step_name"))
    rows = history.join(names, "job_id").join(titles, ["job_id", "step_id"], "left")
    started = F.try_to_timestamp(
        F.format_string("%08d%06d", F.col("run_date").cast("int"), F.col("run_time").cast("int")),
        F.lit("yyyyMMddHHmmss"),
    ).cast("timestamp_ntz")
    took = F.col("run_duration").cast("long")
    # Hours have as many digits as they need.
    part = [F.floor(took / 10000), F.floor(took / 100) % 100, took % 100]
    seconds = (part[0] * 3600 + part[1] * 60 + part[2]).cast("int")
    clock = F.when(took.isNotNull(), F.format_string("%02d:%02d:%02d", *part))
    status = F.lit(None).cast("string")
    for code, text in RUN_STATUS.items():
        status = F.when(F.col("run_status") == code, text).otherwise(status)
    present = F.localtimestamp() if now is None else F.lit(str(now)).cast("timestamp_ntz")
    return rows.withColumn("_at", started).select(
        F.col("name").alias("JobName"),
        "step_id",
        F.concat(
            F.lit("step "),
            F.right((F.col("step_id") + 1000).cast("string"), F.lit(3)),
            F.lit(". "),
            F.coalesce("step_name", F.lit("Job Status")),
        ).alias("StepName"),
        F.col("_at").cast("date").alias("RunDate"),
        F.col("_at").alias("RunDateAndTime"),
        clock.alias("duration_time"),
        seconds.alias("duration_sec"),
        status.alias("RunStatus"),
        F.concat(seconds.cast("string"), F.lit(" sec duration. "), F.col("message")).alias("message"),
        F.timestamp_diff("SECOND", F.col("_at"), present).alias("sec_ago"),
        F.lit(1).alias("site_id"),
    )
