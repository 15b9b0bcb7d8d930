"""Year-to-date series by month or ISO week."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.functions.calendar import calendar_columns
from chronoweave.functions.text import to_int
from chronoweave.model import VALUES, Run, as_fact_day
from chronoweave.operators.intervals import Cuts
from chronoweave.operators.matching import ANY, Reading, Want, filterable, own_window


def wants(runs: Sequence[Run]) -> list[Want]:
    """`p1` is the forecast to read; a filter shorter than 4 characters means the own activity."""
    return [
        Want(
            r,
            filter=r.filter if len(r.filter) >= 4 else "",
            activity=ANY if len(r.filter) >= 4 else r.activity_id,
            forecast=to_int(r.p1),
        )
        for r in runs
    ]


def year_to_date(
    facts: DataFrame,
    runs: Sequence[Run],
    activity: DataFrame | None = None,
    when: dt.datetime | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Running totals of all ten values within a year, one row per period with data.

    Level `p2` with a "w": ISO weeks within the ISO year, otherwise months within the year. Each
    row is dated at the last day with data; accumulation starts at the window's first day.
    """
    reading = Reading(facts.sparkSession, wants(runs))
    rows = reading.rows(reading.in_any_window(filterable(facts, activity, dates)))
    # Per span before imports are attached: a filter that n imports share is aggregated once. All days of a
    # span are in the same windows and periods, so its last day stands for them. Spans and not days, as a
    # task holds a row for each in memory.
    per_span = (
        rows.withColumns(spans(runs))
        .groupBy(*KEEP, *spans(runs))
        .agg(F.max("date").alias("date"), *[F.sum(v).alias(v) for v in VALUES])
    )
    dated = reading.attach(per_span, {"weekly": ("boolean", lambda w: weekly(w.run))}).where(own_window())
    cal = calendar_columns(F.col("date"))
    series = ["import_id", "site_id", "activity_id", "to_forecast"]
    per_period = (
        dated.withColumn("season", F.when(F.col("weekly"), cal["year52"]).otherwise(cal["year"]))
        .withColumn("period", F.when(F.col("weekly"), cal["week"]).otherwise(cal["month"]))
        .groupBy(*series, "season", "period")
        .agg(F.max("date").alias("date"), *[F.sum(v).alias(v) for v in VALUES])
    )
    # At most 53 rows per window partition, whatever the size of the facts.
    so_far = (
        W.partitionBy(*series, "season")
        .orderBy("date")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    totals = per_period.select(
        *series, "date", *[F.sum(v).over(so_far).alias(v) for v in VALUES]
    )
    return as_fact_day(totals.withColumnRenamed("to_forecast", "forecast_id"), when)


KEEP = ["filter_no", "site_id", "activity_key", "forecast_key", "activity_id"]


def weekly(run: Run) -> bool:
    return "w" in run.p2.lower()


def spans(runs: Sequence[Run]) -> dict[str, Column]:
    """What tells spans of days apart: the periods in use, and where windows begin or end between the outermost bounds."""
    date = F.col("date")
    out = {"_week" if w else "_month": F.trunc(date, "WEEK" if w else "MM") for w in sorted({weekly(r) for r in runs})}
    first, last = min(r.date_from for r in runs), max(r.date_until for r in runs)
    begun = {r.date_from for r in runs} | {r.date_until + dt.timedelta(1) for r in runs if r.date_until < last}
    # A window that ends before it begins holds no day and may lie outside of all others.
    if cuts := {d for d in begun if first < d <= last}:
        out["_cut"] = F.shiftright(Cuts("date", "date", cuts).place() + 1, 1)
    return out
