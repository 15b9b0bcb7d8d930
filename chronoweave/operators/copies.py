"""Copies of imports, file settings, activities and of the series that imports wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.model import broadcast_if_small, run_time

NUMBERED_TOGETHER = 10_000


def id_list(text: str) -> list[int]:
    """The ids of a comma-separated list."""
    return [int(p) for p in text.split(",") if p.strip()]


def listed(rows: DataFrame, column: str, ids: str | DataFrame) -> DataFrame:
    """Rows whose `column` is in a comma-separated list, or in the first column of a table."""
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).cast("int").alias(column)).distinct()
        return rows.join(broadcast_if_small(keys), column, "left_semi")
    return rows.where(F.col(column).isin(*id_list(ids)))


def number_by_id(rows: DataFrame, id_column: str, first: int, as_column: str) -> DataFrame:
    """Consecutive numbers from `first` in the order of a unique id, without one global sort.

    Ids are numbered within ranges of `NUMBERED_TOGETHER`; only the counts of the ranges pass
    through a single running total.
    """
    ranged = rows.withColumn("_range", F.floor(F.col(id_column) / NUMBERED_TOGETHER))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(id_column))
    return (
        ranged.withColumn("_row", inside)
        .join(starts, "_range")
        .withColumn(as_column, (F.lit(first) + F.col("_start") + F.col("_row") - 1).cast("int"))
        .drop("_range", "_row", "_start")
    )


def _stamped(rows: DataFrame, values: dict[str, Column], guid: str, when) -> DataFrame:
    fresh = {guid: F.uuid(), "date_updated": run_time(when), "date_created": run_time(when)}
    fresh = {n: c for n, c in fresh.items() if n in rows.columns}
    return rows.withColumns({**fresh, **values})


def copy_imports(
    imports: DataFrame,
    ids: str | DataFrame,
    forecast_to: int,
    first_id: int,
    when: dt.datetime | None = None,
) -> DataFrame:
    """New imports equal to the listed ones but for the forecast, with ids from `first_id`.
    `old_import_id` keeps the map to the originals."""
    chosen = number_by_id(listed(imports, "import_id", ids), "import_id", first_id, "_new")
    copies = _stamped(
        chosen.withColumn("old_import_id", F.col("import_id")),
        {"import_id": F.col("_new"), "forecast_id": F.lit(forecast_to)},
        "import_guid",
        when,
    )
    return copies.select(*imports.columns, "old_import_id")


def copy_series(facts: DataFrame, copies: DataFrame, forecast_to: int) -> DataFrame:
    """The day facts of the copied imports under the new forecast and import ids; everything
    else, `date_updated` included, as it was."""
    ids = copies.select(
        F.col("old_import_id").alias("import_id"), F.col("import_id").alias("_new")
    )
    return (
        facts.join(broadcast_if_small(ids), "import_id")
        .withColumns({"import_id": F.col("_new"), "forecast_id": F.lit(forecast_to)})
        .select(*facts.columns)
    )


def copy_files(
    files: DataFrame,
    ids: str | DataFrame,
    site_id: int,
    first_id: int,
    forecast_to: int | None = None,
    suffix: str = "",
    session: str | None = None,
    when: dt.datetime | None = None,
) -> DataFrame:
    """New file settings equal to the site's listed ones; optionally another forecast, and a
    suffix on the category. `date_created` stays that of the original."""
    chosen = listed(files, "file_id", ids).where(F.col("site_id") == site_id)
    numbered = number_by_id(chosen, "file_id", first_id, "_new")
    values = {"file_id": F.col("_new"), "session": F.lit(session).cast("string")}
    if forecast_to is not None:
        values["forecast_id"] = F.lit(forecast_to)
    if suffix:
        values["category"] = F.concat(F.coalesce("category", F.lit(None)), F.lit(suffix))
    if "file_guid" in files.columns:
        values["file_guid"] = F.uuid()
    if "date_updated" in files.columns:
        values["date_updated"] = run_time(when)
    return numbered.withColumns(values).select(*files.columns)


def duplicate_activities(
    activity: DataFrame,
    imports: DataFrame,
    ids: str | DataFrame,
    first_activity_id: int,
    first_import_id: int,
    search: str | None = None,
    replacement: str = "",
    domain: str | None = None,
    when: dt.datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New activities with a text replaced in their names and optionally a new domain, and
    copies of all their imports for the new activities."""
    chosen = number_by_id(listed(activity, "activity_id", ids), "activity_id", first_activity_id, "_new")
    values = {"activity_id": F.col("_new")}
    if search:
        values["activity_name"] = F.replace("activity_name", F.lit(search), F.lit(replacement))
    if domain is not None:
        values["domain"] = F.lit(domain)
    activities = _stamped(chosen, values, "activity_guid", when).select(*activity.columns)

    targets = chosen.select("activity_id", F.col("_new").alias("_activity"))
    numbered = number_by_id(
        imports.join(targets, "activity_id"), "import_id", first_import_id, "_new"
    )
    copied = _stamped(
        numbered,
        {"import_id": F.col("_new"), "activity_id": F.col("_activity")},
        "import_guid",
        when,
    ).select(*imports.columns)
    return activities, copied
