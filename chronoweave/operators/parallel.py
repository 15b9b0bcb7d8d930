"""Parallel period: the series of earlier years laid over the days of the window."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.calendar import same_day_in_year, same_week_in_year
from chronoweave.functions.text import field_list, to_int
from chronoweave.model import VALUES, Run, as_fact_day, union_all
from chronoweave.operators.matching import (
    ANY,
    KEYS,
    Reading,
    Want,
    filterable,
)


def wants(runs: Sequence[Run]) -> list[Want]:
    """`p1` is the forecast to read; a blank filter means the own activity."""
    return [
        Want(
            r,
            filter=r.filter,
            activity=ANY if r.filter.strip() else r.activity_id,
            forecast=to_int(r.p1),
        )
        for r in runs
    ]


def source_span(run: Run) -> tuple[dt.date, dt.date]:
    """Days of the source that can land in the run's window; a week of slack covers the shift
    between ISO weeks of different years."""
    return _moved(run.date_from, -to_int(run.p5), -10), _moved(run.date_until, -to_int(run.p5), 10)


def target_span(run: Run, first: dt.date, last: dt.date) -> tuple[dt.date, dt.date]:
    """Days that source days from first to last can land on, with the same slack."""
    return _moved(first, to_int(run.p5), -10), _moved(last, to_int(run.p5), 10)


def _moved(d: dt.date, years: int, slack: int) -> dt.date:
    year = min(max(d.year + years, 1), 9999)
    base = dt.date(year, d.month, min(d.day, 28)).toordinal() + slack
    return dt.date.fromordinal(min(max(base, dt.date.min.toordinal()), dt.date.max.toordinal()))


def parallel_period(
    facts: DataFrame,
    runs: Sequence[Run],
    activity: DataFrame | None = None,
    when: dt.datetime | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Each source day moved `p5` years on, if it lands in the window.

    Default alignment: same weekday and ISO week, by ISO year. Level `p2` with an "m": same day
    and month. Days without a counterpart (week 53, 29 February) give no row. The move is a
    function of the date, so there is no join to a calendar and no shuffle.
    """
    shapes: dict[tuple, list[Run]] = defaultdict(list)
    for r in runs:
        fields, targets = field_list(r.fields_source), field_list(r.fields_target)
        if not fields or not targets:
            fields, targets = list(VALUES), list(VALUES)
        shapes[tuple(fields), tuple(targets)].append(r)
    return union_all(
        _parallel(facts, group, fields, targets, activity, when, dates)
        for (fields, targets), group in shapes.items()
    )


def _parallel(facts, runs, fields, targets, activity, when, dates) -> DataFrame:
    reading = Reading(facts.sparkSession, wants(runs))
    spans = [source_span(r) for r in runs]
    near = F.col("date").between(F.lit(min(s[0] for s in spans)), F.lit(max(s[1] for s in spans)))
    rows = reading.rows(filterable(facts.where(near), activity, dates))
    mapped = rows.select(
        *KEYS,
        "activity_id",
        F.col("date").alias("source_date"),
        *[F.expr(f).try_cast("double").alias(t.strip("`")) for f, t in zip(fields, targets)],
    )
    attached = reading.attach(
        mapped,
        {
            "monthly": ("boolean", lambda w: "m" in w.run.p2.lower()),
            "lag_years": ("int", lambda w: to_int(w.run.p5)),
        },
    )
    source, lag = F.col("source_date"), F.col("lag_years")
    moved = attached.withColumn(
        "date",
        F.when(F.col("monthly"), same_day_in_year(source, lag)).otherwise(
            same_week_in_year(source, lag)
        ),
    ).where(F.col("date").between(F.col("date_from"), F.col("date_until")))
    return as_fact_day(moved.withColumn("forecast_id", F.col("to_forecast")), when)
