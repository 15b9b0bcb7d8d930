"""Monthly totals split to days in proportion to a reference profile."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.functions.calendar import day_of_year_in, with_calendar
from chronoweave.functions.text import field_list, string_spaces, to_scale
from chronoweave.model import BROADCAST_BYTES, Run, as_fact_day, union_all
from chronoweave.operators.matching import KEYS, Reading, Want, target_series, with_dates


def split_totals(
    facts: DataFrame,
    runs: Sequence[Run],
    when: dt.datetime | None = None,
    drop_feb29: bool = False,
    calendar: tuple[dt.date, dt.date] | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Day values `share of the month * total of the month * p5`.

    The profile is the facts that meet `filter`, which may use calendar attributes such as
    `year=2022`. The n-th total in `source` (space separated) belongs to the profile's n-th
    month. Profile days move to the days with the same number in the years of the window.
    `drop_feb29` leaves 29 February out of the profile. Open ends of a window are those of
    `calendar`, without which they are an error; a given window is used as it is.
    """
    for r in runs:
        if not r.filter.strip() or not r.source.strip():
            raise ValueError(f"import {r.import_id}: a split needs a filter and totals in source")
    runs = [r.closed(calendar) for r in runs]
    shapes: dict[tuple, list[Run]] = defaultdict(list)
    for r in runs:
        fields = field_list(r.fields_source) or ["value1"]
        targets = field_list(r.fields_target) or ["value1"]
        shapes[tuple(fields), tuple(targets)].append(r)
    return union_all(
        _split(facts, group, fields, targets, when, drop_feb29, dates)
        for (fields, targets), group in shapes.items()
    )


def _split(facts, runs, fields, targets, when, drop_feb29, dates) -> DataFrame:
    reading = Reading(facts.sparkSession, [Want(r, filter=r.filter) for r in runs])
    profile = reading.rows(with_dates(with_calendar(facts), dates))
    if drop_feb29:
        profile = profile.where(~((F.col("month") == 2) & (F.col("day_month") == 29)))
    profile = profile.select(*KEYS, "date", "year_month", "day_year", "value1")

    # Totals per month first: a handful of rows per filter, so neither the ranking below nor
    # the join back to the profile moves the profile itself through a window.
    months = profile.groupBy(*KEYS, "year_month").agg(F.sum("value1").alias("month_sum"))
    in_order = W.partitionBy(*KEYS).orderBy("year_month")
    months = months.withColumn("month_no", F.dense_rank().over(in_order))
    totals = reading.runs(
        {
            "totals": ("string", lambda w: w.run.source.replace(",", ".")),
            "scale": ("double", lambda w: to_scale(w.run.p5)),
            "first_day": ("date", lambda w: w.run.date_from),
            "last_day": ("date", lambda w: w.run.date_until),
        }
    ).select(
        "*", F.posexplode(F.split(string_spaces(F.col("totals")), " ")).alias("_pos", "_text")
    )
    totals = totals.select(
        *KEYS,
        "import_id",
        "to_activity",
        "to_forecast",
        "first_day",
        "last_day",
        "scale",
        (F.col("_pos") + 1).alias("month_no"),
        F.col("_text").try_cast("double").alias("total"),
    )
    shares = months.join(totals, [*KEYS, "month_no"])
    # A month of a filter meets at most one total of each import, so the totals bound the rows.
    most_bytes = sum(len(r.source.split()) for r in runs) * len(shares.columns) * 8
    if most_bytes <= BROADCAST_BYTES:
        shares = F.broadcast(shares)
    years = F.sequence(F.year("first_day"), F.year("last_day"))
    days = (
        profile.join(shares, [*KEYS, "year_month"])
        .where(F.col("first_day") <= F.col("last_day"))
        .withColumn("_year", F.explode(years))
        .withColumn("date", day_of_year_in(F.col("_year"), F.col("day_year")))
        .where(F.col("date").between(F.col("first_day"), F.col("last_day")))
        .withColumn(
            "value1",
            F.try_divide(F.col("value1"), F.col("month_sum")) * F.col("total") * F.col("scale"),
        )
    )
    mapped = target_series(days).select(
        "date",
        "activity_id",
        "forecast_id",
        "import_id",
        "site_id",
        *[F.expr(f).try_cast("double").alias(t.strip("`")) for f, t in zip(fields, targets)],
    )
    return as_fact_day(mapped, when)
