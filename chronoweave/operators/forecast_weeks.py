"""Forecast weeks of the date table, taken from a staged file with one column per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.model import LETTERS

# Columns C..N hold the years 2015 onwards.
YEAR_COLUMNS = LETTERS[2:14]
FIRST_YEAR = 2015


def staged_forecast_weeks(staged: DataFrame, week_base: int = 202500) -> DataFrame:
    """`day_week_set, week, year52, year_week_fc` from the staged layout A, B, C..N.

    Blank cells are skipped. 1 stands for the row's own week (`week_base + week`), 0 for no
    week; any other number is taken as it is.
    """
    cells = staged.select(
        F.col("A").alias("day_week_set"),
        F.trim("B").try_cast("int").alias("week"),
        *YEAR_COLUMNS,
    ).unpivot(["day_week_set", "week"], list(YEAR_COLUMNS), "letter", "cell")
    number = F.trim("cell").try_cast("int")
    return cells.where(F.trim("cell") != "").select(
        "day_week_set",
        "week",
        (F.lit(FIRST_YEAR) + F.ascii("letter") - F.ascii(F.lit(YEAR_COLUMNS[0]))).alias("year52"),
        F.when(number == 1, F.lit(week_base) + F.col("week")).when(number != 0, number).alias("year_week_fc"),
    )


def assign_forecast_weeks(dates: DataFrame, staged: DataFrame, week_base: int = 202500) -> DataFrame:
    """`dates` with `year_next_week_fc` replaced where the staged file has its weekday set, week
    and ISO year; other rows keep theirs. Of repeated staged rows the largest week counts."""
    keys = ["year52", "day_week_set", "week"]
    new = (
        staged_forecast_weeks(staged, week_base)
        .groupBy(*keys)
        .agg(F.max("year_week_fc").alias("_new"))
        .withColumn("_found", F.lit(True))
    )
    columns = dates.columns
    joined = dates.join(new, keys, "left")
    return joined.withColumn(
        "year_next_week_fc",
        F.when(F.col("_found"), F.col("_new")).otherwise(F.col("year_next_week_fc")),
    ).select(*columns)
