"""Date and interval dimensions, generated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.calendar import with_calendar

INTERVALS_PER_DAY = 96


def date_dimension(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day with all calendar attributes; the two user-kept columns start empty."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return with_calendar(days).withColumns(
        {
            "day_week_set": F.lit(None).cast("string"),
            "year_next_week_fc": F.lit(None).cast("int"),
        }
    )


def interval_of(ts: Column) -> Column:
    """The 15-minute interval of the day, 0..95."""
    return (F.hour(ts) * 4 + F.floor(F.minute(ts) / 15)).cast("smallint")


def interval_dimension(spark: SparkSession) -> DataFrame:
    """The 96 quarter hours of a day.

    `time_end` equals `time_start` as the reporting model defines it; `time_end_exclusive` is
    the real end.
    """
    n = F.col("id").cast("int")
    hour, minute = F.floor(n / 4).cast("int"), (n % 4) * 15
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    start = F.concat(two(hour), F.lit(":"), two(minute))
    next_minute = (n + 1) * 15
    base = F.lit("1899-12-30 00:00:00").cast("timestamp_ntz")
    return spark.range(INTERVALS_PER_DAY).select(
        n.cast("smallint").alias("interval_id"),
        start.alias("time_start"),
        start.alias("time_end"),
        (base + F.make_dt_interval(mins=n * 15)).alias("time_start_datetime"),
        (base + F.make_dt_interval(mins=n * 15 + 14, secs=F.lit(59))).alias("time_end_datetime"),
        two(hour).alias("time_hour"),
        hour.cast("smallint").alias("time_hour_int"),
        F.when(minute == 0, "00-29").when(minute == 30, "30-59").alias("time_halfhour"),
        two(minute).alias("time_minute"),
        minute.cast("smallint").alias("time_minute_int"),
        F.concat(hour.cast("string"), F.lit(":"), two(minute), F.lit(":00")).alias("time_start_sec"),
        F.concat(hour.cast("string"), F.lit(":"), two(minute + 14), F.lit(":59")).alias("time_end_sec"),
        (minute % 30 == 0).alias("period_30"),
        (minute == 0).alias("period_60"),
        F.concat(
            two(F.floor(next_minute / 60) % 24), F.lit(":"), two(next_minute % 60)
        ).alias("time_end_exclusive"),
    )
