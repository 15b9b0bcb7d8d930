"""Import of a source into day and 15-minute facts, and detection of the source's date range."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.text import field_list, sql_text
from chronoweave.model import (
    VALUES,
    Run,
    as_fact_day,
    as_fact_intraday,
    literal_rows,
    local_table,
    union_all,
)
from chronoweave.operators.matching import match_filters, numbered

# What an empty source reports as its first and last day.
EMPTY_FIRST = dt.date(9999, 1, 1)
EMPTY_LAST = dt.date(1900, 12, 31)


@dataclass(frozen=True)
class Shape:
    """Imports of one shape differ only in filter, window and target: one scan serves them."""

    date: str
    fields: tuple[str, ...]
    targets: tuple[str, ...]
    grouped: bool
    by_import_field: str = ""


def shape_of(run: Run, import_field: str = "", columns: Collection[str] = ()) -> Shape:
    """`-SUMFIELDS` sums each field as a number and forces grouping, over `-NOGROUPBY`."""
    sources, targets = field_list(run.fields_source, columns), field_list(run.fields_target)
    if not sources or not targets:
        sources, targets = list(VALUES), list(VALUES)
    if len(sources) != len(targets):
        raise ValueError(
            f"import {run.import_id}: {len(sources)} source fields but {len(targets)} target fields"
        )
    sums = run.has("SUMFIELDS")
    if sums and not any("SUM(" in s.upper() for s in sources):
        sources = [f"sum(try_cast({s} as double))" for s in sources]
    own = import_field or "import_id" if run.has("SOURCE_FILTER_IMPORT") else ""
    return Shape(
        date=sql_text(run.group_by, columns) or "date",
        fields=tuple(sources),
        targets=tuple(t.strip("`") for t in targets),
        grouped=sums or not run.has("NOGROUPBY"),
        by_import_field=own,
    )


def _by_shape(runs: Sequence[Run], import_field: str, columns: Collection[str]) -> dict[Shape, list[Run]]:
    groups: dict[Shape, list[Run]] = defaultdict(list)
    for run in runs:
        groups[shape_of(run, import_field, columns)].append(run)
    return groups


def import_day(
    source: DataFrame,
    runs: Sequence[Run],
    when: dt.datetime | None = None,
    import_field: str = "",
) -> DataFrame:
    """New day facts of `runs`, all of which read `source`.

    Per import: rows that meet its filter, dated by its `group_by` expression (default `date`)
    and within its window, grouped per day by the aggregates in `fields_source`, which fill the
    columns in `fields_target`. `-NOGROUPBY` takes rows as they are. Values that are not
    numbers become null.
    """
    parts = [
        _import(source, shape, group, when, None)
        for shape, group in _by_shape(runs, import_field, source.columns).items()
    ]
    return union_all(parts)


def import_intraday(
    source: DataFrame,
    runs: Sequence[Run],
    when: dt.datetime | None = None,
    durations: dict[int, int] | None = None,
) -> DataFrame:
    """As `import_day`, per day and `interval_id`; `durations` overrides 15 minutes per import."""
    parts = [
        _import(source, shape, group, when, durations or {})
        for shape, group in _by_shape(
            [replace(r, flags=r.flags - {"SOURCE_FILTER_IMPORT"}) for r in runs], "", source.columns
        ).items()
    ]
    return union_all(parts)


def _import(
    source: DataFrame,
    shape: Shape,
    runs: list[Run],
    when: dt.datetime | None,
    durations: dict[int, int] | None,
) -> DataFrame:
    spark = source.sparkSession
    intraday = durations is not None
    filters = numbered(sql_text(r.filter, source.columns) for r in runs)
    site = "site_id" in source.columns
    first, last = min(r.date_from for r in runs), max(r.date_until for r in runs)

    dated = source.withColumn("_day", F.expr(shape.date).cast("date"))
    dated = dated.where(F.col("_day").between(F.lit(first), F.lit(last)))
    if site:
        dated = dated.where(F.col("site_id").isin(*sorted({r.site_id for r in runs})))
    if shape.by_import_field:
        matched = dated.withColumn("_import", F.col(shape.by_import_field).cast("int"))
        keys = ["_import"]
    else:
        matched = match_filters(dated, list(filters), "_filter")
        keys = ["_filter"]
    if site:
        matched = matched.withColumn("_site", F.col("site_id").cast("int"))
        keys.append("_site")
    per_day = [*keys, "_day"]
    if intraday:
        matched = matched.withColumn("_interval", F.col("interval_id").cast("smallint"))
        per_day.append("_interval")

    values = [F.expr(f).try_cast("double").alias(t) for f, t in zip(shape.fields, shape.targets)]
    if shape.grouped:
        try:
            found = matched.groupBy(*per_day).agg(*values)
        except AnalysisException as e:
            raise ValueError(
                "fields of a grouped import must be aggregates; use -SUMFIELDS to sum them or "
                f"-NOGROUPBY to take rows as they are: {shape.fields}"
            ) from e
    else:
        found = matched.select(*per_day, *values)

    columns = (
        "_filter int, _import int, _site int, import_id int, activity_id int, forecast_id int, "
        "site_id int, date_from date, date_until date, duration_min smallint"
    )
    targets = [
        {
            "_filter": filters[sql_text(r.filter, source.columns)],
            "_import": r.import_id,
            "_site": r.site_id,
            "import_id": r.import_id,
            "activity_id": r.activity_id,
            "forecast_id": r.forecast_id,
            "site_id": r.site_id,
            "date_from": r.date_from,
            "date_until": r.date_until,
            "duration_min": (durations or {}).get(r.import_id, 15),
        }
        for r in runs
    ]
    in_window = F.col("_day").between(F.col("date_from"), F.col("date_until"))
    if keys == ["_filter"] and len(filters) == 1:
        # A join on a constant would be a nested loop: the targets go along with each row.
        each = literal_rows(targets, columns)
        own = F.filter(each, lambda t: F.col("_day").between(t["date_from"], t["date_until"]))
        rows = found.drop("_filter").select("*", F.inline(own))
    else:
        rows = found.join(local_table(spark, targets, columns), keys).where(in_window)
    rows = rows.withColumn("date", F.col("_day"))
    if not intraday:
        return as_fact_day(rows, when)
    return as_fact_intraday(rows.withColumn("interval_id", F.col("_interval")), when)


def delta_range(source: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """`import_id, first, last`: the dates each import's filtered source really covers.

    One aggregate pass for all imports; an import without source rows gets 9999-01-01 and
    1900-12-31.
    """
    spark = source.sparkSession
    site = "site_id" in source.columns
    by_date: dict[str, list[Run]] = defaultdict(list)
    for run in runs:
        by_date[sql_text(run.group_by, source.columns) or "date"].append(run)
    parts = []
    for date, group in by_date.items():
        filters = numbered(sql_text(r.filter, source.columns) for r in group)
        keys = ["_filter", "_site"] if site else ["_filter"]
        dated = source.withColumn("_day", F.expr(date).cast("date"))
        if site:
            dated = dated.withColumn("_site", F.col("site_id").cast("int"))
        found = (
            match_filters(dated, list(filters), "_filter")
            .groupBy(*keys)
            .agg(F.min("_day").alias("_min"), F.max("_day").alias("_max"))
        )
        table = local_table(
            spark,
            [
                {"_filter": filters[sql_text(r.filter, source.columns)], "_site": r.site_id, "import_id": r.import_id}
                for r in group
            ],
            "_filter int, _site int, import_id int",
        )
        parts.append(
            table.join(found, keys, "left").select(
                "import_id",
                F.coalesce("_min", F.lit(EMPTY_FIRST)).alias("first"),
                F.coalesce("_max", F.lit(EMPTY_LAST)).alias("last"),
            )
        )
    return union_all(parts)


def clamp_window(
    date_from: Column, date_until: Column, first: Column, last: Column, force: Column
) -> tuple[Column, Column]:
    """The window to refresh: cut to the source's range, or that range itself if forced."""
    return (
        F.when(force, first).otherwise(F.greatest(date_from, first)),
        F.when(force, last).otherwise(F.least(date_until, last)),
    )


def delta_windows(source: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """`import_id, date_from, date_until, has_rows` after the source's range is applied.

    `-NODELTA` keeps the configured window unless `-FORCEDELTA` is also present.
    """
    table = local_table(
        source.sparkSession,
        [
            {
                "import_id": r.import_id,
                "date_from": r.date_from,
                "date_until": r.date_until,
                "forced": r.has("FORCEDELTA"),
                "skipped": r.has("NODELTA") and not r.has("FORCEDELTA"),
            }
            for r in runs
        ],
        "import_id int, date_from date, date_until date, forced boolean, skipped boolean",
    )
    lo, hi = clamp_window(
        F.col("date_from"), F.col("date_until"), F.col("first"), F.col("last"), F.col("forced")
    )
    return (
        table.join(delta_range(source, runs), "import_id")
        .select(
            "import_id",
            F.when(F.col("skipped"), F.col("date_from")).otherwise(lo).alias("date_from"),
            F.when(F.col("skipped"), F.col("date_until")).otherwise(hi).alias("date_until"),
        )
        .withColumn("has_rows", F.col("date_until") >= F.col("date_from"))
    )
